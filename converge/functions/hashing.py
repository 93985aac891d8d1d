"""Stable hashing into buckets: large hexadecimal numbers modulo n, in built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Hexadecimal digits that are folded at a time; a remainder below 2**31 times 2**32 stays within 64 bits.
_CHUNK = 8


def _once(value: Column, of) -> Column:
    """of(value) with the value made once: it is bound as the element of an array, where a column would be written out at each use."""
    return F.transform(F.array(value), of)[0]


def lanes(digits: Column, count: int) -> Column:
    """The numbers that each 8 hexadecimal digits write, so many of them from the start."""
    return _once(digits, lambda d: F.array(*[F.conv(F.substring(d, _CHUNK * k + 1, _CHUNK), 16, 10).cast("bigint") for k in range(count)]))


def hex_mod(digits: Column, length: int, n: int) -> Column:
    """The number that `length` hexadecimal digits write, modulo n (up to 2**31)."""
    if 16 % n == 0 or (n & (n - 1) == 0 and n <= 1 << 32):
        # A power of two keeps the last digits only.
        return F.conv(F.substring(digits, length - _CHUNK + 1, _CHUNK), 16, 10).cast("bigint") % n

    def rest(d: Column) -> Column:
        out = F.lit(0).cast("bigint")
        for at in range(0, length, _CHUNK):
            out = (out * (1 << 4 * _CHUNK) + F.conv(F.substring(d, at + 1, _CHUNK), 16, 10).cast("bigint")) % n
        return out

    return _once(digits, rest)


def md5_mod(value: Column, n: int) -> Column:
    return hex_mod(F.md5(value.cast("binary")), 32, n)


def sha256_mod(value: Column, n: int) -> Column:
    return hex_mod(F.sha2(value.cast("binary"), 256), 64, n)


def bucket_id(document_id: Column, buckets: int = 1024) -> Column:
    """bucket-0000 and so on, with as many digits as the number of buckets has, four at least."""
    width = max(4, len(str(buckets)))
    return F.concat(F.lit("bucket-"), F.lpad(md5_mod(document_id, buckets).cast("string"), width, "0"))


def child_bucket_id(parent: Column, depth: int, document_id: Column, fanout: int = 16) -> Column:
    """The parent's id and a child of two digits, by a hash of parent, depth and document."""
    which = sha256_mod(F.concat_ws(":", parent, F.lit(str(depth)), document_id), fanout)
    return F.concat(parent, F.lit("/child-"), F.lpad(which.cast("string"), 2, "0"))
