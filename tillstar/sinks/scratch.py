"""Tables between steps, in a folder of the session that every executor reaches."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_kept: set[str] = set()
_owned: ContextVar[str | None] = ContextVar("owned", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The session's own folder for tables between steps, which every executor can reach.

    It lies in `spark.checkpoint.dir`, or in the warehouse where that is unset, and is
    deleted when the driver ends. On a cluster the warehouse must then be shared storage:
    a folder of the driver's machine is refused. Inside `scratch` it is that block's folder.
    """
    owned = _owned.get()
    if owned is not None:
        return owned
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir")
        alone = base.startswith(("/", "file:")) or ":" not in base
        if alone and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor reaches")
    folder = f"{base.rstrip('/')}/scratch-{spark.sparkContext.applicationId}"
    if folder not in _kept:
        _kept.add(folder)
        atexit.register(_end, spark._jvm, spark._jsc.hadoopConfiguration(), folder)
    return folder


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A block that owns the tables which its steps write between them.

    They lie in a folder of the block, deleted when it ends, also by an error: results must be
    written or collected inside. Blocks may be nested; those of other threads are apart. A
    session that runs many queries thus holds the tables of those at work alone.
    """
    folder = f"{shared_folder(spark)}/block-{uuid.uuid4().hex}"
    before = _owned.set(folder)
    try:
        yield folder
    finally:
        _owned.reset(before)
        drop_folders(spark, folder)


def drop_folders(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def replace_folder(spark: SparkSession, fresh: str, path: str) -> None:
    """Give a finished folder the place of another."""
    new, old = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (fresh, path))
    system = old.getFileSystem(spark._jsc.hadoopConfiguration())
    system.delete(old, True)
    if not system.rename(new, old):
        raise OSError(f"{fresh} could not take the place of {path}")


def _end(jvm, configuration, folder: str) -> None:
    """Also after the session was stopped; a driver that was killed leaves its folder."""
    with suppress(Exception):
        where = jvm.org.apache.hadoop.fs.Path(folder)
        where.getFileSystem(configuration).delete(where, True)


@contextmanager
def _dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffles of the statements inside go when each ends, not when the driver collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def settled(df: DataFrame) -> DataFrame:
    """Compute a table once for several readers.

    The rows are written to the shared folder and read back, so each reader
    scans only its columns and a lost executor never repeats the work before. They are packed
    by zstd, which takes less room than Spark's default; the shuffles that made them are dropped.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/settled-{uuid.uuid4().hex}"
    with _dropping_shuffles(spark):
        df.write.parquet(path, compression="zstd")
    return spark.read.schema(df.schema).parquet(path)


def settled_by(df: DataFrame, *keys: str) -> DataFrame:
    """`settled`, with rows of equal keys in one bucket, of as many as there are shuffle partitions.

    Joins and groups by these keys then need no shuffle, and wide rows take less than half the
    room that they take in one: columns are packed apart. A key that owns much of the data
    stays one task. The catalog knows the table only while it is written.
    """
    spark = df.sparkSession
    name = f"settled_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = df.write.format("parquet").option("compression", "zstd")
    with _dropping_shuffles(spark):
        writer.bucketBy(buckets, *keys).option("path", f"{shared_folder(spark)}/{name}").saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE `{name}`")
    return table
