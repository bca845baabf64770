"""Layer tables, full-refresh loads with row counts, and dated export files."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillstar.operators.numbering import in_order, offsets
from tillstar.sinks.scratch import (
    drop_folders, replace_folder, scratch, settled, settled_by, shared_folder,
)
from tillstar.sources.readers import read_competitor_seed

__all__ = [
    "as_view", "commented", "drop_folders", "export_csv", "export_parquet", "load_csv", "read_ordered",
    "scratch", "settled", "settled_by", "shared_folder", "target_database", "write_all", "write_bucketed", "write_ordered",
    "write_table",
]

# Databases of the production target by layer.
PRODUCTION = {"staging": "dev_warehouse", "core": "dev_warehouse", "marts": "warehouse"}
COMMENT_LIMIT = 1024


def target_database(
    layer: str | None, env: str, base: str, production: Mapping[str, str] = PRODUCTION
) -> str:
    """Database a layer is written to.

    In production `production` names the databases of layers; other layers keep
    their own name. Elsewhere it is `<base>_<layer>`. Without a layer it is the base.
    """
    if layer is None:
        return base
    layer = layer.strip()
    if env == "prod":
        return production.get(layer, layer)
    return f"{base}_{layer}"


def commented(
    df: DataFrame, comments: Mapping[str, str], limit: int = COMMENT_LIMIT
) -> DataFrame:
    """Attach column descriptions, cut to the catalog's limit."""
    for name, text in comments.items():
        if name in df.columns:
            df = df.withMetadata(name, {"comment": text[:limit]})
    return df


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Staging relation: a named query without storage."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def _laid_out(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rebalance rows by the partition columns, so files are few and even.

    Adaptive execution splits a partition value that holds most of the rows.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def _location(spark: SparkSession, name: str) -> str | None:
    """Folder of a stored table, None where there is no such table."""
    if not spark.catalog.tableExists(name):
        return None
    rows = spark.sql(f"DESCRIBE EXTENDED {_quoted(name)}").where("col_name = 'Location'")
    return rows.first().data_type


def write_table(
    df: DataFrame,
    name: str,
    partition_by: Sequence[str] = (),
    comment: str | None = None,
    path: str | None = None,
) -> DataFrame:
    """Full refresh of a stored table; returns the stored table.

    The rows are written beside the old ones, to a folder of this refresh under `path` (default:
    a folder of the table's name in its database); the catalog then drops the old table and gives
    its name to the new one, which moves no data. A refresh that fails before leaves the old
    table as it was, and `df` may read it. Folders of earlier refreshes go after the swap.
    """
    spark = df.sparkSession
    database, _, table = name.rpartition(".")
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    if path is None:
        home = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
        path = f"{home.rstrip('/')}/{table}-refreshed"
    fresh = f"{path.rstrip('/')}/{uuid.uuid4().hex}"
    coming = f"{name}__refresh_{uuid.uuid4().hex}"
    writer = _laid_out(df, partition_by).write.format("parquet").option("path", fresh)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.saveAsTable(coming)
        if comment is not None:
            text = comment[:COMMENT_LIMIT].replace("\\", "\\\\").replace("'", "\\'")
            spark.sql(f"COMMENT ON TABLE {_quoted(coming)} IS '{text}'")
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {_quoted(coming)}")
        drop_folders(spark, fresh)
        raise
    old = _location(spark, name)
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(name)}")
    spark.sql(f"ALTER TABLE {_quoted(coming)} RENAME TO {_quoted(name)}")
    if old is not None and old.rstrip("/").rpartition("/")[0].endswith(path.rstrip("/")):
        drop_folders(spark, old)
    return spark.table(name)


def write_bucketed(
    df: DataFrame, name: str, key: str, buckets: int, sort_by: str | None = None
) -> DataFrame:
    """Full refresh of a table bucketed on a join key, for joins without a shuffle."""
    writer = df.write.mode("overwrite").format("parquet").bucketBy(buckets, key)
    writer.sortBy(sort_by or key).saveAsTable(name)
    return df.sparkSession.table(name)


def write_all(frames: Mapping[str, DataFrame], folder: str) -> dict[str, int]:
    """Replace `folder/<name>` with each frame and return its row count.

    Rows are counted while they are written, not by a second pass. They are written beside the
    old ones, which go once all of them are there: a load that fails leaves the old rows.
    """
    counts = {}
    for name, df in frames.items():
        seen = Observation()
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        fresh = f"{folder}/_{name}-{uuid.uuid4().hex}"
        counted.write.parquet(fresh)
        counts[name] = seen.get["rows"]
        replace_folder(df.sparkSession, fresh, f"{folder}/{name}")
    return counts


def _write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header that the declared readers read back as it was, blanks included."""
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").options(header=True, escape='"', **kept).csv(path)


def write_ordered(df: DataFrame, path: str, order_by: Sequence[str | Column]) -> None:
    """Parquet files whose rows are sorted, from the first row of the first to the last of the last."""
    in_order(df, order_by).write.mode("overwrite").parquet(path)


def read_ordered(spark: SparkSession, path: str, position: str) -> DataFrame:
    """Rows of `write_ordered` with their position from 1, in the order of files and rows."""
    read = spark.read.parquet(path)
    columns = read.columns
    name = F.col("_metadata.file_name")
    parts = [F.regexp_extract(name, p, 1).cast("bigint") for p in (r"^part-(\d+)", r"-c(\d+)")]
    placed = read.select(
        "*", F.struct(*[p.alias(f"p{k}") for k, p in enumerate(parts)]).alias("__file"),
        F.col("_metadata.row_index").alias("__row"),
    )
    sizes = placed.groupBy("__file").agg(F.count("*").alias("__size"))
    starts = offsets(sizes, "__file", "__size", "__start")
    number = (F.col("__row") + F.col("__start") + 1).cast("bigint").alias(position)
    return placed.join(starts, "__file").select(number, *columns)


def export_csv(df: DataFrame, folder: str, name: str, run_date: dt.date) -> str:
    path = f"{folder}/{name}_{run_date.isoformat()}.csv"
    _write_csv(df, path)
    return path


def export_parquet(df: DataFrame, folder: str, name: str, run_date: dt.date) -> str:
    path = f"{folder}/{name}_{run_date.isoformat()}.parquet"
    df.write.mode("overwrite").parquet(path)
    return path


def load_csv(spark: SparkSession, df: DataFrame, folder: str, table: str) -> DataFrame:
    """Write enriched listings as CSV and refill the landing table from the same rows."""
    _write_csv(df, folder)
    return write_table(read_competitor_seed(spark, folder), table)
