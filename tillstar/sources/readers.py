"""Readers with declared schemas; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillstar.sources import schemas
from tillstar.sources.records import read_records


def read_source(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """One declared table stored as parquet under `folder/table`."""
    return spark.read.schema(schemas.SOURCES[table]).parquet(f"{folder}/{table}")


def read_sources(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: read_source(spark, folder, name) for name in schemas.RETAIL_TABLES}


def read_catalog_sources(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    """The declared tables from a catalog database."""
    return {name: spark.table(f"{database}.{name}") for name in schemas.RETAIL_TABLES}


def read_landing(spark: SparkSession, folder: str) -> DataFrame:
    """The landing table of enriched competitor listings, stored like the declared tables."""
    return read_source(spark, folder, "competitor_listings")


def _csv(spark: SparkSession, path: str, schema, line_breaks: bool) -> DataFrame:
    if line_breaks:
        return read_records(spark, path, schema)
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .csv(path)
    )


def read_competitor_seed(
    spark: SparkSession, path: str, line_breaks: bool = True
) -> DataFrame:
    """Enriched competitor listings from CSV, columns typed as the landing table.

    Titles may hold line breaks inside quotes, which takes a pass over the files to tell where
    records begin; `line_breaks=False` spares it for files known to have none.
    """
    return _csv(spark, path, schemas.SOURCES["competitor_listings"], line_breaks)


def read_raw_listings(spark: SparkSession, path: str, line_breaks: bool = True) -> DataFrame:
    """Competitor listings before enrichment; `line_breaks` as in `read_competitor_seed`."""
    return _csv(spark, path, schemas.RAW_LISTINGS, line_breaks)


def read_listing_json(spark: SparkSession, path: str) -> DataFrame:
    """Search results, one JSON document per line, as text for `flatten_listings`."""
    return spark.read.text(path).withColumnRenamed("value", "item")
