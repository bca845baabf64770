"""Slowly changing dimensions and point-in-time joins.

Intervals are half open: `valid_from` <= day < `valid_to`, `valid_to` null while current.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.operators.joins import null_spread, zero_of


def scd2_from_versions(df: DataFrame, keys: Sequence[str], valid_from: str) -> DataFrame:
    """Add `valid_to` and `is_current` to a table of dated versions.

    Versions of a key that start at the same time follow in the order of the other columns;
    all but the last are valid for no time. The window partition is bounded by the
    versions of the key however many facts the key has.
    """
    others = [c for c in df.columns if c not in (*keys, valid_from)]
    window = Window.partitionBy(*keys).orderBy(valid_from, *others)
    following = F.lead(valid_from).over(window)
    return df.withColumn("valid_to", following).withColumn(
        "is_current", F.col("valid_to").isNull()
    )


def current(df: DataFrame) -> DataFrame:
    """Current versions only."""
    return df.where(F.col("is_current"))


def slot_of(day: Column, months: int) -> Column:
    """Number of the stretch of so many months that a day lies in."""
    number = F.year(day) * 12 + F.month(day) - 1
    return F.floor(number / F.lit(months)).cast("int")


def as_of_join(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    at: str | Column,
    how: str = "left",
    spread_by: str | None = None,
    months: int = 12,
    until: Column | None = None,
) -> DataFrame:
    """Join each fact row to the dimension version valid on its day.

    `dim` holds `key`, `valid_from`, `valid_to` and the columns wanted; these
    three are dropped from the result. Time is cut into slots of `months`; each version is
    laid into the slots it covers, and a fact looks for its version in the slot of its day: the
    join is on key and slot, the interval is tested last. So a fact tests the versions of its slot
    alone, and a key with very many versions or facts is as many tasks as it has slots. Open
    versions reach to the slot of `until` (default: today), which also takes all later days: the
    result doesn't depend on it. `at` may be an expression, which is computed on either side of
    the shuffle and not carried through it. `spread_by` scatters facts without a key, as in `left_lookup`.
    """
    wanted = [c for c in dim.columns if c not in (key, "valid_from", "valid_to")]
    end = slot_of(F.current_date() if until is None else until.cast("date"), months)

    def slot(day: Column) -> Column:
        return F.least(slot_of(day, months), end)

    first, after = F.col("__from"), F.col("__to")
    last = F.when(after.isNull(), end).otherwise(slot(F.date_sub(after, 1)))
    right = (
        dim.select(
            F.col(key).alias("__key"),
            F.col("valid_from").cast("date").alias("__from"),
            F.col("valid_to").cast("date").alias("__to"),
            *wanted,
        )
        # a version that ends when it begins holds on no day
        .where(F.col("__key").isNotNull() & (after.isNull() | (first < after)))
        .withColumn("__covered", F.explode(F.sequence(slot(first), last)))
    )
    if how == "inner":
        left = fact.where(F.col(key).isNotNull())
        condition = F.col(key) == F.col("__key")
    else:
        left = fact
        condition = F.col(key) == F.col("__key")
        if spread_by is not None:
            left = left.withColumn("__spread", null_spread(F.col(key).isNull(), spread_by))
            right = right.withColumn("__zero", zero_of("__key"))
            condition = condition & (F.col("__spread") == F.col("__zero"))
    at = F.col(at) if isinstance(at, str) else at
    left = left.withColumn("__slot", slot(at.cast("date")))
    condition = condition & (F.col("__slot") == F.col("__covered"))
    inside = (at >= first) & (after.isNull() | (at < after))
    return left.join(right, condition & inside, how).drop(
        "__key", "__from", "__to", "__spread", "__zero", "__slot", "__covered"
    )


def scd2_apply(
    history: DataFrame,
    snapshot: DataFrame,
    keys: Sequence[str],
    check_columns: Sequence[str],
    as_of: Column,
    close_deleted: bool = True,
) -> DataFrame:
    """Next state of a versioned table after a full snapshot of its source.

    A changed key closes its open version at `as_of` and opens a new one; a new
    or re-appearing key opens one; a key missing from the snapshot is closed
    when `close_deleted`; everything else stays as it is. `history` has the
    snapshot's columns plus `valid_from`, `valid_to` and `is_current`. Open
    versions meet the snapshot in one full outer join, which yields both the
    old and the new row; closed versions pass by without a shuffle.
    """
    columns = snapshot.columns
    open_rows = history.where(F.col("is_current"))
    closed_rows = history.where(~F.col("is_current"))

    old = open_rows.select(
        F.struct(*columns).alias("old"), F.col("valid_from").alias("old_from")
    )
    new = snapshot.select(F.struct(*columns).alias("new"))
    same_key = reduce(
        lambda a, b: a & b, [F.col(f"old.{k}") == F.col(f"new.{k}") for k in keys]
    )
    pairs = old.join(new, same_key, "full_outer")

    differs = reduce(
        lambda a, b: a | b,
        [~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in check_columns],
    )
    had, has = F.col("old").isNotNull(), F.col("new").isNotNull()
    changed = had & has & differs
    deleted = had & ~has
    ends = (changed | deleted) if close_deleted else changed

    moment = as_of.cast(history.schema["valid_from"].dataType)
    nothing = F.lit(None).cast(history.schema["valid_to"].dataType)
    kept = F.when(
        had,
        F.struct(
            F.col("old").alias("row"),
            F.col("old_from").alias("valid_from"),
            F.when(ends, moment).otherwise(nothing).alias("valid_to"),
            (~ends).alias("is_current"),
        ),
    )
    opened = F.when(
        has & (~had | changed),
        F.struct(
            F.col("new").alias("row"),
            moment.alias("valid_from"),
            nothing.alias("valid_to"),
            F.lit(True).alias("is_current"),
        ),
    )
    rows = pairs.select(F.explode(F.array_compact(F.array(kept, opened))).alias("v"))
    result = rows.select("v.row.*", "v.valid_from", "v.valid_to", "v.is_current")
    return result.unionByName(closed_rows.select(*result.columns))
