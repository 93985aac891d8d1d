"""Encoders of the public vocabularies that give the tokenizer files' own ids for every text, whatever its length."""

from __future__ import annotations

import base64
import json
import os
import re
from functools import cache

#: A run of blanks of this length goes to the tokenizer file itself: the faster encoder's pattern backtracks once per blank.
LONG_BLANKS = 10_000
_LONG_BLANKS = re.compile(r"\s{%d}" % LONG_BLANKS)


def ranks_path() -> str:
    """The ranks of the public byte-level vocabulary; the JSON file beside it has the same ids, and the added tokens."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def pieces_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _beside(path: str) -> str:
    return os.path.splitext(path)[0] + ".json"


def added_tokens(path: str) -> dict[str, int]:
    """Texts and ids of the tokens that the tokenizer file beside the ranks adds to them; none without such a file."""
    if not os.path.exists(_beside(path)):
        return {}
    with open(_beside(path), encoding="utf-8") as f:
        return {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}


@cache
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@cache
def _fast(path: str):
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(path), special_tokens=added_tokens(path))


@cache
def _exact(path: str, plain: bool):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(_beside(path))
    found.encode_special_tokens = plain
    return found


def byte_level(path: str, plain: bool = False):
    """A function from a text to its list of ids. plain: an added token's text is ordinary text, else it is that token."""
    fast = _fast(path)
    encode = fast.encode_ordinary if plain else lambda text: fast.encode(text, allowed_special="all")

    def ids(text: str) -> list[int]:
        if _LONG_BLANKS.search(text):
            return _exact(path, plain).encode(text, add_special_tokens=False).ids
        return encode(text)

    return ids


@cache
def piece_model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def piece_bytes(path: str) -> list[bytes]:
    """The bytes that each id of a piece model stands for: U+2581 is a space, <0xHH> a byte."""
    model = piece_model(path)
    text = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    return [bytes([int(t[3:5], 16)]) if model.is_byte(i) else t.replace("▁", " ").encode() for i, t in enumerate(text)]
