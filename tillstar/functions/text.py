"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(value: Column) -> Column:
    """Remove white space of any kind at both ends."""
    return F.regexp_replace(value, r"^\s+|\s+$", "")


def part(value: Column, separator: str, position: int) -> Column:
    """Trimmed piece number `position` (from 0) of a separated text, null when absent."""
    return F.trim(F.try_element_at(F.split(value, separator), F.lit(position + 1)))


def words(value: Column) -> Column:
    return F.split(strip(value), r"\s+")


def title_case(value: Column) -> Column:
    """Capitalise every run of letters, so `t-shirts` becomes `T-Shirts`."""
    runs = F.regexp_extract_all(value, F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def capitalize_words(value: Column) -> Column:
    """Capitalise the first letter of each blank-separated word and lower the rest."""
    return F.initcap(F.regexp_replace(strip(value), r"\s+", " "))


def contains_any(value: Column, needles: list[str]) -> Column:
    found = F.lit(False)
    for needle in needles:
        found = found | value.contains(needle)
    return found
