"""Physical plans that must hold at any size."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from contract.queries import event_house, order_house
from tillstar.operators.scd import as_of_join


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    """Plans as they are when no side is small enough to broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize(
    "name",
    ["rpt_transactions", "fct_sessions", "competitor_listings", "scd2_snapshot",
     "relationship_counts", "rpt_daily_channel_performance"],
)
def test_no_pairing_of_large_tables(name, spark, sf_dir, no_broadcast):
    text = plan(entry.queries()[name](spark, sf_dir))
    assert not re.search(r"CartesianProduct|NestedLoop", text)


def test_scan_reads_only_needed_columns(spark, sf_dir):
    text = plan(order_house(spark, sf_dir).stg_transactions.select("transaction_id", "date"))
    assert re.search(r"ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>", text)
    assert "PushedFilters: [IsNotNull(o_orderdate)]" in text


def test_keyless_facts_are_spread_over_tasks(spark, sf_dir, no_broadcast):
    house = order_house(spark, sf_dir)
    dim = house.dim_users.select("customer_id", "valid_from", "valid_to", "plus_tier")
    fact = house.stg_transactions.select("transaction_id", "customer_id", "date")
    joined = as_of_join(fact, dim, "customer_id", "date", spread_by="transaction_id")
    assert re.search(r"hashpartitioning\(customer_id#\d+L, __spread#\d+", plan(joined))
    lost = fact.where(F.col("customer_id").isNull())
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spread = as_of_join(lost, dim, "customer_id", "date", spread_by="transaction_id")
    used = spread.select(F.spark_partition_id().alias("p")).distinct().count()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert used > 1


def test_sessions_meet_their_metrics_without_another_shuffle(spark, sf_dir, no_broadcast):
    house = event_house(spark, sf_dir)
    from tillstar.operators.sessions import session_metrics

    joined = house.stg_sessions.join(session_metrics(house.stg_funnel_events), "session_id", "left")
    text = plan(joined)
    # One exchange per aggregate, none for the join itself.
    assert len(re.findall(r"Exchange hashpartitioning\(session_id", text)) == 2


def test_unpivot_scans_once(spark, sf_dir):
    text = plan(event_house(spark, sf_dir).stg_ad_platform_unpivoted)
    assert text.count("FileScan") == 1


def test_calendar_is_broadcast_by_its_size(spark, sf_dir):
    house = order_house(spark, sf_dir)
    joined = house.stg_transactions.join(house.dim_date, "date", "left")
    assert "BroadcastHashJoin" in plan(joined)


def test_no_global_window_over_facts(spark, sf_dir):
    """A window without a partition only sums group sizes of a dimension."""
    for name in ("rpt_customer_activity", "rpt_transactions", "event_sequence"):
        text = plan(entry.queries()[name](spark, sf_dir))
        assert "SinglePartition" not in text


def test_tables_are_read_as_they_are(spark, sf_dir):
    text = plan(order_house(spark, sf_dir).fct_transactions)
    assert "REPARTITION" not in text


def test_units_are_shuffled_once_per_key(spark, sf_dir, no_broadcast):
    """Header and purchase times find the units partitioned by order."""
    units = order_house(spark, sf_dir).sold_units
    text = plan(units)
    moved = [x for x in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)]
    by_order = [x for x in moved if x.startswith("transaction_id")]
    # the units, the headers, and the events by order and product, then by order
    assert len(by_order) == 4 and not any("__spread" in x for x in moved)


@pytest.mark.parametrize("name", ["weekly_brand_sales", "average_order_value", "category_profitability"])
def test_reports_read_only_what_they_show(name, spark, sf_dir, no_broadcast):
    text = plan(entry.queries()[name](spark, sf_dir))
    assert "Window" not in text  # no customer versions
    if name != "average_order_value":
        assert "orders.parquet" not in text  # no headers either
    assert not re.search(r"count\(distinct", text)


@pytest.mark.parametrize(
    "name",
    ["rpt_customer_activity", "rpt_customer_activity_as_of", "daily_spend_metrics",
     "rpt_daily_channel_performance", "check_activity_timeline", "competitor_fct_items"],
)
def test_plans_hold_behind_settled_tables(name, spark, sf_dir, no_broadcast, monkeypatch):
    """The whole plan, with tables between steps left lazy."""
    monkeypatch.setattr("tillstar.plans.warehouse.settled", lambda df: df)
    text = plan(entry.queries()[name](spark, sf_dir))
    assert not re.search(r"CartesianProduct|NestedLoop|EvalPython|InPandas", text)
    # only the numbering of sources and places sums group sizes in one task
    if name.startswith("rpt_customer"):
        assert "SinglePartition" not in text


def test_hot_day_of_a_customer_uses_many_tasks(spark):
    """A third of all events on one day of one customer is numbered in groups of its own."""
    from tillstar.operators.sequences import sequence_events

    events = spark.range(3000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"),
        F.lit("2024-01-01").cast("date").alias("day"), (F.col("id") % 300).alias("order"),
    )
    text = plan(sequence_events(events, "k", "day", ["order", "id"]))
    numbering = [x for x in text.splitlines() if "row_number()" in x]
    assert numbering and all("order" in x.split("windowspecdefinition(")[1] for x in numbering)


def test_events_are_shuffled_once_for_their_sequence(spark, no_broadcast, tmp_path):
    """The join with the group offsets leaves them as the window wants them, nulls included."""
    from tillstar.operators.sequences import sequence_events

    path = f"{tmp_path}/events"
    spark.range(500).select(
        F.col("id"), (F.col("id") % 9).alias("k"), F.lit("2024-01-01").cast("date").alias("day"),
        F.when(F.col("id") % 3 > 0, F.col("id") % 30).alias("order"), F.lit("x").alias("load"),
    ).write.parquet(path)
    text = plan(sequence_events(spark.read.parquet(path), "k", "day", ["order", "id"]))
    window = text[text.index("row_number()"):]
    first = window.index("Exchange")
    assert "SortMergeJoin" in window[:first]  # no shuffle between the window and the join
    shuffles = [x for x in text.split("Exchange")[1:] if "load#" in x.split("FileScan")[0]]
    assert len(shuffles) <= 1


def test_activity_mix_needs_neither_order_nor_catalog(spark, sf_dir, no_broadcast):
    text = plan(order_house(spark, sf_dir).activity_mix)
    assert "row_number()" not in text and "Expand" not in text
    assert "p_name" not in text


def shuffled(text):
    """Keys of the shuffles of a plan, from its result downwards."""
    return re.findall(r"Exchange hashpartitioning\((\w+?)#", text)


def test_units_meet_their_return_while_narrow(spark, sf_dir, no_broadcast):
    """The shuffle by unit carries neither header nor times."""
    keys = shuffled(plan(order_house(spark, sf_dir).sold_units))
    assert keys[0] == "transaction_id" and keys.index("item_id") > 0


def test_labels_are_computed_after_the_last_shuffle(spark, sf_dir, no_broadcast):
    text = plan(order_house(spark, sf_dir).fct_transactions)
    below = text[text.index("Exchange"):]
    assert "pricing_type" in text
    for name in ("pricing_type", "product_revenue", "return_rate_pct", "sold_on"):
        assert name not in below


def test_sales_meet_the_calendar_last(spark, sf_dir, no_broadcast):
    text = plan(order_house(spark, sf_dir).rpt_transactions)
    keys = list(dict.fromkeys(shuffled(text)))
    assert keys[:3] == ["date_key", "product_id", "transaction_id"]
    # customers meet the orders, not their units
    by_customer = [x for x in text.split("\n") if "Exchange hashpartitioning(customer_id" in x]
    assert by_customer
    below = text[text.index("Exchange hashpartitioning(customer_id"):]
    assert "l_shipdate" not in below.split("FileScan")[0]


def test_activity_shows_its_days_after_the_catalog(spark, sf_dir, no_broadcast):
    text = plan(order_house(spark, sf_dir).rpt_customer_activity)
    keys = list(dict.fromkeys(shuffled(text)))
    assert keys[:2] == ["activity_date", "product_id"]
    below = text[text.index("Exchange hashpartitioning(product_id"):].split("FileScan")[0]
    assert "activity_timestamp" not in below and "activity_is_weekend" not in below


def test_days_of_a_sequence_are_counted_from_the_events(spark, no_broadcast, tmp_path):
    from tillstar.operators.sequences import sequence_events

    path = f"{tmp_path}/events"
    spark.range(500).select(
        F.col("id"), (F.col("id") % 9).alias("k"), F.lit("2024-01-01").cast("date").alias("day"),
        (F.col("id") % 30).alias("order"),
    ).write.parquet(path)
    text = plan(sequence_events(spark.read.parquet(path), "k", "day", ["order", "id"]))
    by_group = re.findall(r"Exchange hashpartitioning\(k#\w+, day#\w+, __order#", text)
    # the events, the sizes of their groups, and the offsets on their way back
    assert len(by_group) == 3


def test_settled_tables_are_packed(spark):
    from tillstar.sinks.scratch import settled

    [file] = settled(spark.range(10).repartition(1)).inputFiles()
    assert ".zstd." in file
