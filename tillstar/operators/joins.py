"""Joins that hold up when one key, or a missing key, owns much of the data."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def null_spread(missing: Column, *spread_by: str, values: int | None = None) -> Column:
    """Zero for rows with a key, for rows without one a hash below `values`, by default as
    many as there are shuffle partitions."""
    if values is None:
        values = int(SparkSession.active().conf.get("spark.sql.shuffle.partitions"))
    scattered = F.pmod(F.xxhash64(*spread_by), F.lit(max(1, values))).cast("int")
    return F.when(missing, scattered).otherwise(0)


def zero_of(column: str) -> Column:
    """Zero in a form that stays a join column.

    A literal would be folded into a filter on the other side, and the join
    would then be shuffled on the key alone.
    """
    return F.pmod(F.hash(column), F.lit(1))


def left_lookup(
    df: DataFrame,
    other: DataFrame,
    on: Sequence[str] | str,
    spread_by: Sequence[str] | str | None = None,
    null_safe: Sequence[str] = (),
) -> DataFrame:
    """Left equi-join on same-named columns, keeping one copy of the key.

    Rows with a null key never match, yet a plain hash shuffle sends them all
    to one task. `spread_by` names columns whose hash scatters those rows over
    the values of a second join column that is zero for real keys.
    A `__spread` column that `df` brings along (a table stored by it) is used as it is.
    In the `null_safe` columns null equals null. Hot real keys are left to
    adaptive skew-join splitting, and the choice of a broadcast to Spark's own
    size check.
    """
    on = [on] if isinstance(on, str) else list(on)
    right = other
    for name in on:
        right = right.withColumnRenamed(name, f"__{name}")
    equal = [
        F.col(n).eqNullSafe(F.col(f"__{n}")) if n in null_safe else F.col(n) == F.col(f"__{n}")
        for n in on
    ]
    condition = reduce(lambda a, b: a & b, equal)
    if spread_by is not None:
        spread_by = [spread_by] if isinstance(spread_by, str) else list(spread_by)
        missing = reduce(
            lambda a, b: a | b, [F.col(n).isNull() for n in on if n not in null_safe]
        )
        if "__spread" not in df.columns:
            df = df.withColumn("__spread", null_spread(missing, *spread_by))
        right = right.withColumn("__zero", zero_of(f"__{on[0]}"))
        condition = condition & (F.col("__spread") == F.col("__zero"))
    joined = df.join(right, condition, "left")
    return joined.drop("__spread", "__zero", *[f"__{name}" for name in on])


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child keys without a parent and the child rows that carry each.

    Counting per key first means a hot child key crosses the shuffle once per map task.
    """
    keys = (
        child.where(F.col(child_key).isNotNull())
        .groupBy(F.col(child_key).cast("string").alias("key"))
        .agg(F.count("*").alias("child_rows"))
    )
    known = parent.select(F.col(parent_key).cast("string").alias("key"))
    return keys.join(known, "key", "left_anti")
