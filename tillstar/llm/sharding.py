"""Sharding by a two-pass external shuffle, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstar.llm.common import Tables, column

#: Bytes of the records of one bucket, which a task shuffles in memory.
BUCKET = 32 << 20


def shuffled_shards(
    df: DataFrame,
    shards: int,
    size: str = "size",
    seed: int = 20,
    bucket_bytes: int = BUCKET,
) -> DataFrame:
    """Deal all rows out to `shards` shards in a uniformly random order.

    Pass one writes each record with a seeded hash of its place in the input, which scatters the
    records uniformly into buckets of about `bucket_bytes` by the column `size` (bytes; null is 0).
    Pass two gathers a bucket, shuffles it in memory (Spark's `shuffle` is a Fisher-Yates
    shuffle), and numbers the records on from the buckets before it. Number n goes to shard
    n mod `shards` as its slot n div `shards`, so that shards differ by one row at most and slots
    have no gaps.

    Adds shard (int) and slot (long); input columns of these names give way. Keys play no part:
    equal rows, equal or null ids and hot sources spread like all others. A record larger than a
    bucket makes its bucket larger. An empty table stays empty. Columns must be of types that
    Spark can order (no maps).
    """
    if shards < 1:
        raise ValueError("there must be a shard")
    names = [c for c in df.columns if c.lower() not in ("shard", "slot")]
    tables = Tables(df.sparkSession, "shards")
    place = F.xxhash64(F.monotonically_increasing_id(), F.lit(seed))
    scattered = tables.write(
        "scattered",
        df.select(
            F.struct(*[column(c) for c in names]).alias("record"),
            place.alias("place"),
            F.coalesce(column(size).cast("long"), F.lit(0)).alias("bytes"),
        ),
    )
    total = scattered.agg(F.sum("bytes").alias("bytes")).first()["bytes"] or 0
    buckets = max(1, -(-total // bucket_bytes))
    bucket = F.pmod(F.xxhash64("place", F.lit(seed + 1)), F.lit(buckets)).alias("bucket")
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        scattered.groupBy(bucket)
        .agg(F.count(F.lit(1)).alias("rows"))
        .select("bucket", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    )
    # one row a bucket on either side, on one partitioning
    drawn = (
        scattered.select(bucket, F.struct("place", "record").alias("item"))
        .repartition("bucket")
        .groupBy("bucket")
        .agg(F.sort_array(F.collect_list("item")).alias("items"))
        .join(offsets, "bucket")
        # a known order of buckets, so that a repeated task draws the same order again
        .sortWithinPartitions("bucket")
        .select("offset", F.posexplode(F.shuffle("items", F.lit(seed))).alias("at", "item"))
    )
    number = F.col("offset") + F.col("at")
    return drawn.select(
        *[F.col("item.record")[c].alias(c) for c in names],
        (number % shards).cast("int").alias("shard"),
        F.floor(number / shards).cast("long").alias("slot"),
    )


def write_shards(df: DataFrame, folder: str) -> None:
    """Write shards as folders shard=N whose files hold the slots in order.

    Ranges of (shard, slot) make a large shard several files, named in order.
    """
    ordered = df.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.write.partitionBy("shard").parquet(folder)
