"""CSV files whose fields may hold line breaks, read by many tasks each.

A line break belongs to a record if the quotes before it, in the whole file, are odd in number. Two
passes find that out without reading a file from its start: the first counts the quotes of
stretches of lines, whose running sums tell how each stretch begins; the second cuts every stretch
into records on its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar.sinks.scratch import settled

#: Lines of a stretch: one row of the first pass stands for so many.
LINES = 10_000
WHERE = ["file", "block", "stretch"]


def _lines(spark: SparkSession, path: str, lines: int) -> DataFrame:
    """Lines with their file, byte range, stretch of the range, and place within the file."""
    number = F.monotonically_increasing_id()
    read = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), "value", number.alias("at"),
    )
    within = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return read.select(
        "*", F.floor(within / lines).alias("stretch"), (quotes % 2).alias("odd")
    )


def _stretches(lines: DataFrame) -> DataFrame:
    """One row a stretch: whether it begins inside a field, whether each of its lines is a record,
    and the place of the file's header, if that is in it."""
    counted = lines.groupBy(*WHERE).agg(
        F.sum("odd").alias("odd"), F.min("at").alias("first")
    )
    order = Window.partitionBy("file").orderBy("block", "stretch")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    opened = F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2
    return counted.select(
        *WHERE, opened.alias("opened"),
        F.when(F.row_number().over(order) == 1, F.col("first")).alias("header"),
        ((opened == 0) & (F.col("odd") == 0)).alias("plain"),
    )


def _joined(lines: DataFrame) -> DataFrame:
    """Records of stretches in which some begin or end amid a line break."""
    order = Window.partitionBy(*WHERE).orderBy("at")
    before = F.coalesce(
        F.sum("odd").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    begins = F.when((F.col("opened") + before) % 2 == 0, F.struct("block", "at"))
    marked = lines.select("file", "block", "stretch", "at", "value", begins.alias("begins"))
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = marked.withColumn("record", F.last("begins", ignorenulls=True).over(upto))
    # the record that a stretch begins within began in the last stretch before that begins one
    files = Window.partitionBy("file").orderBy("block", "stretch")
    earlier = files.rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        marked.groupBy(*WHERE).agg(F.max("begins").alias("latest"))
        .withColumn("carried", F.last("latest", ignorenulls=True).over(earlier))
        .drop("latest")
    )
    place = F.struct("block", "at", "value")
    return (
        own.join(carried, WHERE)
        .groupBy("file", F.coalesce("record", "carried").alias("record"))
        .agg(F.array_sort(F.collect_list(place)).alias("parts"))
        .select(F.array_join(F.transform("parts", lambda p: p["value"]), "\n").alias("value"))
    )


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def _header_of(line: Column, schema: T.StructType) -> Column:
    """Never true; fails where the header doesn't have the declared names in their order."""
    line = F.regexp_replace(line, "^\ufeff|\r$", "")
    names = F.from_csv(line, ", ".join(f"c{k} string" for k in range(len(schema))))
    found = F.lower(F.concat_ws(",", *[names[f"c{k}"] for k in range(len(schema))]))
    wanted = ",".join(f.name.lower() for f in schema)
    told = F.concat(F.lit(f"the header is not {wanted} but "), found)
    return F.when(found == wanted, F.lit(False)).otherwise(F.raise_error(told).cast("boolean"))


def read_records(
    spark: SparkSession, path: str, schema: T.StructType, lines: int = LINES
) -> DataFrame:
    """CSV with a header, quotes doubled inside quoted fields, which may hold line breaks.

    Every byte range of a file is a task of its own. Lines without a quote left open go straight to
    the parser; the others meet the rest of their record. The first pass runs at once; its
    result, a row for `lines` lines, is stored. A field with a quote in it must be quoted.
    """
    read = _lines(spark, path, lines)
    known = settled(_stretches(read))
    rows = read.join(known, WHERE)
    here = F.col("at") == F.col("header")
    rows = rows.where(F.when(here, _header_of(F.col("value"), schema)).otherwise(F.lit(True)))
    single = rows.where("plain").select("value")
    records = single.unionByName(_joined(rows.where("not plain")))
    # without the end of a line that files of other systems have
    text = F.regexp_replace("value", "\r$", "")
    parsed = F.from_csv(text, _ddl(schema), {"escape": '"'})
    return records.where(text != "").select(parsed.alias("row")).select("row.*")
