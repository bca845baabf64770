"""Surrogate and date keys as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_TOKEN = "_null_"
SEPARATOR = "|"


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def key_text(*values: Column | str) -> Column:
    """The text whose digest is the key; that of leading fields may stand for them as one field."""
    parts = [F.coalesce(_column(v).cast("string"), F.lit(NULL_TOKEN)) for v in values]
    return F.concat_ws(SEPARATOR, *parts)


def conformed_key(*values: Column | str) -> Column:
    """Deterministic positive 60-bit key over the given fields.

    Equal inputs give equal keys in every table, so a child row carries its
    parent's key without a lookup join. Nulls get their own token. Give dates,
    integers and strings; a double has no single text form across engines.
    """
    # cut as bytes: Spark would count the characters of the whole text first
    digits = F.substring(F.md5(key_text(*values)).cast("binary"), 1, 15).cast("string")
    return F.conv(digits, 16, 10).cast("bigint")


def change_signature(*values: Column | str) -> Column:
    """Digest of the tracked attributes of one version."""
    return F.md5(key_text(*values))


def date_key(day: Column | str) -> Column:
    """20240131 for 2024-01-31."""
    day = _column(day)
    return (F.year(day) * 10000 + F.month(day) * 100 + F.day(day)).cast("bigint")


def date_from_key(key: Column | str) -> Column:
    key = _column(key).cast("int")
    month = F.floor(key / 100).cast("int") % 100
    return F.make_date(F.floor(key / 10000).cast("int"), month, key % 100)
