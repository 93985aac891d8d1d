"""Source versions, change types and event times of change records, all null where a value cannot be read.

Versions are DECIMAL(38,0): log sequence numbers of 80 bits fit, 64-bit columns would not hold them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

VERSION = "decimal(38,0)"
INT64_MAX = (1 << 63) - 1
# Spellings of change types.
DELETES, REPAIRS, REFRESHES = ("delete", "deleted", "remove"), ("repair",), ("refresh",)


def _hex(part: Column) -> Column:
    """Up to 16 hexadecimal digits as a decimal number."""
    return F.when(part.rlike("^[0-9A-Fa-f]{1,16}$"), F.conv(part, 16, 10).cast("decimal(20,0)"))


def _shifted(number: Column, bits: int) -> Column:
    return (number * F.lit(str(1 << bits)).cast("decimal(17,0)")).cast(VERSION)


def postgres_lsn(text: Column) -> Column:
    """high/low: the high half shifted by 32 bits, and the low one."""
    parts = F.split(text, "/")
    return F.when(F.size(parts) == 2, (_shifted(_hex(parts[0]), 32) + _hex(parts[1])).cast(VERSION))


def sqlserver_lsn(text: Column) -> Column:
    """file:block:slot, shifted by 48, 16 and 0 bits."""
    parts = F.split(text, ":")
    return F.when(F.size(parts) == 3, (_shifted(_hex(parts[0]), 48) + _shifted(_hex(parts[1]), 16) + _hex(parts[2])).cast(VERSION))


def log_version(text: Column, kind: str = "auto") -> Column:
    """A version from the text of a log position: kind is auto, decimal, postgres_lsn or sqlserver_lsn."""
    text = F.trim(text)
    plain = F.when(text.rlike("^[0-9]{1,38}$"), text.try_cast(VERSION))
    kinds = {"decimal": plain, "postgres_lsn": postgres_lsn(text), "sqlserver_lsn": sqlserver_lsn(text)}
    if kind != "auto":
        return kinds[kind]
    return F.when(F.contains(text, F.lit("/")), kinds["postgres_lsn"]).when(F.contains(text, F.lit(":")), kinds["sqlserver_lsn"]).otherwise(plain)


def timestamp_version(ns: Column, us: Column, ms: Column) -> Column:
    """Nanoseconds from the finest clock that is given."""
    as_version = lambda c, factor: (c.try_cast("decimal(20,0)") * F.lit(factor)).cast(VERSION)
    return F.coalesce(as_version(ns, 1), as_version(us, 1000), as_version(ms, 1_000_000))


def whole_number(text: Column) -> Column:
    """A number without a fraction, in any decimal spelling: 42, 42.0 and 4.2e1; exact at any size that fits."""
    number = F.trim(text).try_cast("decimal(38,10)")
    exact = F.trim(text).try_cast(VERSION)
    return F.when(F.trim(text).rlike("^[+-]?[0-9]+$"), exact).when(number == F.floor(number), F.floor(number).cast(VERSION))


def record_sequence(text: Column) -> Column:
    """A number, or else all digits of the text as one; nothing above 63 bits."""
    trimmed = F.trim(text)
    digits = F.regexp_replace(trimmed, "[^0-9]", "")
    number = F.when(trimmed.rlike("^[+-]?[0-9]+$"), trimmed.try_cast(VERSION)).otherwise(F.when(digits != "", digits.try_cast(VERSION)))
    return F.when(number <= F.lit(str(INT64_MAX)).cast(VERSION), number)


def spelled_change(text: Column) -> Column:
    word = F.lower(F.trim(text))
    return F.when(word.isin(*DELETES), F.lit("delete")).when(word.isin(*REPAIRS), F.lit("repair")).when(word.isin(*REFRESHES), F.lit("refresh")).otherwise(F.lit("upsert"))


def op_change(op: Column) -> Column:
    """d, r and t (a truncation, which has no change type) as the log writes them; any other is an upsert."""
    word = F.lower(op)
    return F.when(word == "d", F.lit("delete")).when(word == "r", F.lit("refresh")).when(word == "t", F.lit(None).cast("string")).otherwise(F.lit("upsert"))


def moment(text: Column) -> Column:
    """Epoch seconds or an ISO time; without an offset it is UTC, which the session's time zone must be."""
    seconds = text.try_cast("double")
    return F.when(seconds.isNotNull(), F.timestamp_micros((seconds * 1_000_000).cast("bigint"))).otherwise(text.try_cast("timestamp"))
