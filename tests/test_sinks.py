"""Writers and readers, into a fresh folder each time."""

import datetime as dt
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from contract import queries
from retail import sources
from tillstar.sinks import writers
from tillstar.sinks.writers import scratch, settled, shared_folder
from tillstar.sources import readers, schemas


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.mark.parametrize(
    "layer, env, wanted",
    [
        ("staging", "prod", "dev_warehouse"), ("core", "prod", "dev_warehouse"),
        ("marts", "prod", "warehouse"), ("dim ", "prod", "dim"), (None, "prod", "base"),
        ("staging", "dev", "base_staging"), (None, "dev", "base"), (" marts ", "ci", "base_marts"),
    ],
)
def test_target_database(layer, env, wanted):
    assert writers.target_database(layer, env, "base") == wanted


def test_write_all_counts_and_replaces(spark, folder):
    frames = sources(spark)
    counts = writers.write_all(frames, folder)
    assert counts["users"] == 5 and set(counts) == set(frames)
    assert writers.write_all({"users": frames["users"].limit(2)}, folder) == {"users": 2}
    read = readers.read_sources(spark, folder)
    assert read["users"].count() == 2
    assert read["sessions"].exceptAll(frames["sessions"]).count() == 0
    assert list(read) == schemas.RETAIL_TABLES


def test_exports_are_dated(spark, folder):
    df = spark.createDataFrame([(1, 'say "hi", now', None)], "a bigint, b string, c double")
    day = dt.date(2024, 3, 4)
    csv = writers.export_csv(df, folder, "daily", day)
    assert csv.endswith("daily_2024-03-04.csv")
    back = spark.read.option("header", True).option("escape", '"').schema(df.schema).csv(csv)
    assert back.collect() == df.collect()
    parquet = writers.export_parquet(df, folder, "weekly", day)
    assert parquet.endswith("weekly_2024-03-04.parquet")
    assert spark.read.parquet(parquet).collect() == df.collect()


def test_table_comment_and_partitions(spark):
    df = spark.range(10).select("id", (F.col("id") % 3).alias("part"))
    stored = writers.write_table(df, "unit_sink.t", ["part"], comment="It's " + "x" * 2000)
    assert stored.count() == 10
    described = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED unit_sink.t").collect()}
    assert described["Comment"].startswith("It's x") and len(described["Comment"]) == 1024
    assert "part" in described
    assert writers.write_table(df.limit(1), "unit_sink.t", ["part"]).count() == 1
    spark.sql("DROP DATABASE unit_sink CASCADE")


def test_bucketed_tables_join_without_shuffle(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS unit_bucket")
    a = writers.write_bucketed(spark.range(100).toDF("k"), "unit_bucket.a", "k", 4)
    b = writers.write_bucketed(spark.range(50).toDF("k"), "unit_bucket.b", "k", 4)
    joined = a.hint("merge").join(b, "k")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert joined.count() == 50
    spark.sql("DROP DATABASE unit_bucket CASCADE")


def test_listing_csv_round_trip(spark, folder):
    rows = [
        ("1", "new nike", 'T "x", y\nz', 1.5, "GBP", "Tops", "Nike", "New with box", "mens", "u",
         dt.datetime(2024, 1, 1)),
    ]
    df = spark.createDataFrame(rows, schemas.SOURCES["competitor_listings"])
    stored = writers.load_csv(spark, df, f"{folder}/listings", "default.unit_listings")
    assert stored.collect() == df.collect()
    seed = readers.read_competitor_seed(spark, f"{folder}/listings")
    assert seed.collect() == df.collect()
    raw = df.select(*schemas.RAW_LISTINGS.fieldNames())
    raw.write.option("header", True).option("escape", '"').csv(f"{folder}/raw")
    assert readers.read_raw_listings(spark, f"{folder}/raw").collect() == raw.collect()
    spark.sql("DROP TABLE default.unit_listings")


def test_json_listings_are_read_line_by_line(spark, folder):
    spark.createDataFrame([('{"title":"a"}',), ('{"title":"b"}',)], "value string").write.text(
        f"{folder}/items"
    )
    assert readers.read_listing_json(spark, f"{folder}/items").columns == ["item"]
    assert readers.read_listing_json(spark, f"{folder}/items").count() == 2


def test_settled_table_has_the_same_rows(spark):
    df = spark.range(5).select("id", F.lit(dt.date(2024, 1, 1)).alias("d"))
    again = writers.settled(df)
    assert again.dtypes == df.dtypes and again.exceptAll(df).count() == 0
    assert "Range" not in again._jdf.queryExecution().executedPlan().toString()


def test_comments_stay_on_columns(spark):
    df = writers.commented(spark.range(1), {"id": "y" * 1100, "absent": "z"})
    assert df.schema["id"].metadata["comment"] == "y" * 1024


def test_views(spark):
    assert writers.as_view(spark.range(3), "unit_view").count() == 3
    spark.catalog.dropTempView("unit_view")


def test_catalog_sources(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS unit_src")
    for name, df in sources(spark).items():
        df.write.mode("overwrite").saveAsTable(f"unit_src.{name}")
    assert readers.read_catalog_sources(spark, "unit_src")["users"].count() == 5
    spark.sql("DROP DATABASE unit_src CASCADE")


def test_ordered_files_hold_rows_in_order(spark, folder):
    """Also where one value holds half of the rows, which then fill several files."""
    df = spark.range(40_000).select(
        F.when(F.col("id") % 2 == 0, 5).otherwise(F.col("id") % 100).alias("v"), F.col("id").alias("w")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        writers.write_ordered(df, f"{folder}/ordered", [F.desc("v")])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    read = writers.read_ordered(spark, f"{folder}/ordered", "n")
    got = [tuple(r) for r in read.orderBy("n").collect()]
    assert [r[0] for r in got] == list(range(1, 40_001))
    assert [r[1] for r in got] == sorted((r[1] for r in got), reverse=True)
    assert sorted(r[1:] for r in got) == sorted(tuple(r) for r in df.collect())
    files = spark.read.parquet(f"{folder}/ordered").where("v = 5").select("_metadata.file_name")
    assert files.distinct().count() > 1


def failing(df):
    return df.withColumn("id", F.when(F.col("id") < 3, F.col("id")).otherwise(F.raise_error(F.lit("half-way")).cast("bigint")))


def test_a_failed_refresh_leaves_the_old_rows(spark, folder):
    old = spark.range(3).select("id", (F.col("id") % 2).alias("part"))
    new = spark.range(9).select("id", (F.col("id") % 4).alias("part"))
    for parts in ([], ["part"]):
        for path in (None, f"{folder}/kept{len(parts)}"):
            name = f"unit_swap.t{len(parts)}"
            writers.write_table(old, name, parts, path=path)
            with pytest.raises(Exception, match="half-way"):
                writers.write_table(failing(new), name, parts, path=path)
            assert spark.table(name).count() == 3
            # a table may be made from what it held; its columns may change
            more = spark.table(name).unionByName(new).withColumn("third", F.lit("x"))
            stored = writers.write_table(more, name, parts, comment="c", path=path)
            assert stored.count() == 12 and set(stored.columns) == {"id", "part", "third"}
            assert stored.where("part = 3").count() == 2
            spark.catalog.refreshTable(name)
            assert spark.table(name).count() == 12
            location = writers._location(spark, name)
            spark.sql(f"DROP TABLE {name}")
            assert spark.read.parquet(location).count() == 12  # the data is the folder's
    assert not [t.name for t in spark.catalog.listTables("unit_swap") if not t.isTemporary]
    spark.sql("DROP DATABASE unit_swap CASCADE")

    writers.write_all({"t": old}, folder)
    with pytest.raises(Exception, match="half-way"):
        writers.write_all({"t": failing(new)}, folder)
    assert spark.read.parquet(f"{folder}/t").count() == 3
    more = spark.read.parquet(f"{folder}/t").unionByName(new)
    assert writers.write_all({"t": more}, folder) == {"t": 12}


def test_a_cluster_needs_a_shared_scratch_folder():
    """The warehouse is taken where it is shared or the session is local; else it is refused."""
    from types import SimpleNamespace

    from tillstar.sinks import scratch

    def session(master, warehouse, checkpoint=None):
        settings = {"spark.sql.warehouse.dir": warehouse, "spark.checkpoint.dir": checkpoint}
        context = SimpleNamespace(master=master, applicationId="unit")
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda key, default=None: settings[key]), sparkContext=context,
            _jvm=None, _jsc=SimpleNamespace(hadoopConfiguration=lambda: None),
        )

    for alone in ("/data/wh", "file:/data/wh", "wh"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch.shared_folder(session("spark://h:7077", alone))
        assert scratch.shared_folder(session("local[2]", alone)) == f"{alone}/scratch-unit"
        shared = session("spark://h:7077", alone, "hdfs://n/c/")
        assert scratch.shared_folder(shared) == "hdfs://n/c/scratch-unit"
    assert scratch.shared_folder(session("yarn", "hdfs://n/wh")) == "hdfs://n/wh/scratch-unit"


def test_a_block_owns_its_tables(spark, sf_dir):
    """Ten queries in one session leave no folder behind."""
    base = Path(shared_folder(spark).removeprefix("file:"))
    kept = {p.name for p in base.iterdir()} if base.exists() else set()
    catalog = queries.queries()
    names = ["dense_keys", "dim_geo", "dim_source", "competitor_fct_items", "best_sellers"]
    seen = []
    for name in names * 2:
        with scratch(spark) as folder:
            assert catalog[name](spark, sf_dir).count() >= 0
            with scratch(spark) as inner:
                assert shared_folder(spark) == inner != folder
            assert shared_folder(spark) == folder
            seen.append(Path(folder.removeprefix("file:")))
            written = list(seen[-1].iterdir()) if seen[-1].exists() else []
            assert name == "best_sellers" or written, name
    with pytest.raises(ZeroDivisionError), scratch(spark) as folder:
        settled(spark.range(3))
        seen.append(Path(folder.removeprefix("file:")))
        raise ZeroDivisionError
    assert not any(p.exists() for p in seen)
    assert ({p.name for p in base.iterdir()} if base.exists() else set()) == kept
