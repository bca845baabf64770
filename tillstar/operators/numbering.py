"""Rows in a total order over many tasks: dense integer keys and ordered output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.sinks.scratch import settled


def in_order(df: DataFrame, order_by: Sequence[str | Column]) -> DataFrame:
    """Rows sorted over all partitions: bounds are sampled, each task sorts the rows between two.

    Rows that tie are told apart by a hash of all columns, so a value that holds much of the data
    is spread over several partitions, which then follow each other.
    """
    tie = F.xxhash64(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns])
    return df.repartitionByRange(*order_by, tie).sortWithinPartitions(*order_by, tie)


def offsets(sizes: DataFrame, part: str, size: str, name: str) -> DataFrame:
    """Rows before each part. One task adds up as many numbers as there are parts."""
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(part, F.coalesce(F.sum(size).over(before), F.lit(0)).alias(name))


def dense_key(df: DataFrame, name: str, order_by: Sequence[str]) -> DataFrame:
    """Number distinct rows 1, 2, 3, ... in the order of `order_by`.

    The input is read once: its rows are sorted by range and stored with their partition and their
    place in it; the sizes of the partitions, summed up, are the offsets of the places. Numbering
    under one global window would run in a single task.
    """
    place = F.monotonically_increasing_id()  # partition in the upper bits, place in the lower 33
    stored = settled(in_order(df, order_by).withColumn("__at", place))
    parted = stored.withColumn("__part", F.shiftright("__at", 33))
    sizes = parted.groupBy("__part").agg(F.count("*").alias("__size"))
    # one row a partition
    starts = F.broadcast(offsets(sizes, "__part", "__size", "__start"))
    within = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    number = (within + F.col("__start") + 1).cast("bigint").alias(name)
    return parted.join(starts, "__part").select(number, *df.columns)
