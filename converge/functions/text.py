"""Small readings of names, flags and addresses, as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Texts that stand for true, in requests and in settings.
REQUEST_TRUE, SETTING_TRUE = ("true", "1", "yes"), ("true", "1", "yes", "on")


def collection_name(prefix: str, name: Column, kind: str) -> Column:
    """prefix__name__kind, each run of other characters than ASCII letters, digits, _ and - in the name as one _."""
    return F.concat_ws("__", F.lit(prefix), F.regexp_replace(name, "[^0-9A-Za-z_-]+", "_"), F.lit(kind))


def quoted(part: Column) -> Column:
    """A part of a path with all but ASCII letters, digits and _.-~ escaped in UTF-8."""
    plus = F.replace(F.url_encode(part), F.lit("+"), F.lit("%20"))
    return F.replace(F.replace(plus, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def truth(value: Column, true: tuple[str, ...] = REQUEST_TRUE) -> Column:
    """True for one of the texts, in any case and with spaces around; false for any other and for null."""
    return F.coalesce(F.lower(F.trim(value)).isin(*true), F.lit(False))


def parsed(rows: DataFrame, text: str, into: str) -> DataFrame:
    """rows with the variant of a JSON text, null for none, read once: what stands above a generated row never reads the text again."""
    return rows.select("*", F.explode(F.array(F.try_parse_json(text))).alias(into))
