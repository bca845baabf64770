"""What crosses shuffles, and that moving less changes no rows."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from retail import sources

import __spark_entry__ as entry
from contract.queries import order_house
from tillstar.operators.sequences import group_marks, sequence_events
from tillstar.plans import facts
from tillstar.plans.warehouse import Warehouse
from tillstar.sinks.scratch import scratch, settled, settled_by

D = dt.date


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def shuffles(text):
    """What each shuffle of a plan reads, with its keys, down to the next one."""
    parts = re.split(r"Exchange hashpartitioning\(", text)[1:]
    return [(re.findall(r"(\w+)#", p.split(")")[0]), p) for p in parts]


def events(spark):
    """Events of keys over several years, with busy days, missing ties and missing keys."""
    n = F.col("id")
    return spark.range(900).select(
        n, F.when(n % 31 > 0, F.when(n % 3 == 0, 1).otherwise(n % 7)).alias("k"),
        F.when(n % 37 > 0, F.date_add(F.lit(D(2020, 11, 1)), (n * 7 % 90 * (n % 11)).cast("int")))
        .alias("day"),
        F.when(n % 5 > 0, n % 4).alias("order"), F.lit("load").alias("load"),
    )


@pytest.mark.parametrize("months", [1, 12, 600])
def test_sequence_by_stretches_equals_that_by_days(spark, months):
    rows = events(spark)
    expected = sequence_events(rows, "k", "day", ["order", "id"])
    got = sequence_events(rows, "k", "day", ["order", "id"], months)
    assert got.columns == expected.columns
    assert got.count() == expected.count() > 800
    assert got.exceptAll(expected).isEmpty()


def test_events_stored_by_group_stay_where_they_are(spark, no_broadcast):
    ties = ["order", "id"]
    with scratch(spark):
        marks = group_marks(ties)
        stored = settled_by(events(spark).withColumns(marks), "k", "day", *marks)
        numbered = sequence_events(stored, "k", "day", ties, 12)
        assert not any("load#" in part for _, part in shuffles(plan(numbered)))
        expected = sequence_events(events(spark), "k", "day", ties)
        assert numbered.select(expected.columns).exceptAll(expected).isEmpty()


def test_settled_tables_leave_no_shuffle(spark):
    tracked = spark.sparkContext._jsc.sc().env().mapOutputTracker().shuffleStatuses()
    with scratch(spark):
        before = tracked.size()
        counts = spark.range(100).groupBy((F.col("id") % 3).alias("k")).count()
        assert settled(counts).count() == 3
        assert settled_by(counts, "k").agg(F.sum("count")).first()[0] == 100
        # at most those of the two reads
        assert tracked.size() <= before + 2
        assert not [t for t in spark.catalog.listTables() if t.name.startswith("settled_")]


def test_units_meet_no_customer(spark, sf_dir, no_broadcast):
    """Orders take the days of their units to the customer; the units stay with their order."""
    text = plan(order_house(spark, sf_dir).fct_transactions)
    by_customer = [part for keys, part in shuffles(text) if keys[0] == "customer_id"]
    assert by_customer and not any("product_price" in part for part in by_customer)


def test_purchase_times_take_one_shuffle(spark, sf_dir, no_broadcast):
    """The events move by order, never by order and product."""
    keys = [keys for keys, _ in shuffles(plan(order_house(spark, sf_dir).sold_units))]
    assert ["transaction_id"] in keys and not any(len(k) > 1 and k[0] == "transaction_id" for k in keys)


def test_membership_of_an_order_shipped_over_time(spark):
    """A customer who joins between two units of an order is a member on the second day alone."""
    src = sources(spark)
    unit = src["transactionsanditems"].where("item_id = 1001")
    late = unit.select(*[
        {"item_id": F.lit("1005"), "date": F.lit(D(2024, 2, 2))}.get(c, F.col(c)).alias(c)
        for c in unit.columns
    ])
    src["transactionsanditems"] = src["transactionsanditems"].unionByName(late).unionByName(late)
    for settle in ((), ("dim_users",)):
        with scratch(spark):
            rows = Warehouse(spark, src).settle(*settle).fct_transactions.collect()
            members = sorted((r.item_id, r.plus_status) for r in rows)
            assert members == [
                (1001, None), (1002, None), (1003, None), (1004, None),
                (1005, "true"), (1005, "true"),
            ]


def test_shorter_headers_choose_the_same_row(spark):
    """Of repeated headers the largest counts, however many of its columns are kept."""
    src = sources(spark)
    other = src["transactions"].where("transaction_id = 100").withColumns({
        "customer_id": F.lit("8"), "transaction_total": F.lit(9000.0), "session_id": F.lit("z"),
    })
    src["transactions"] = src["transactions"].unionByName(other)
    house = Warehouse(spark, src)
    tables = (
        house.stg_transactions_and_items, house.stg_transactions, house.stg_product_returns,
        house.stg_funnel_events,
    )
    whole = facts.unit_rows(*tables)
    for last in facts.HEADER:
        kept = facts.HEADER[: facts.HEADER.index(last) + 1]
        rows = facts.unit_rows(*tables, header_to=last)
        assert not set(facts.HEADER) - set(kept) & set(rows.columns)
        assert rows.select("item_id", *kept).exceptAll(whole.select("item_id", *kept)).isEmpty()


def test_versions_are_laid_out_up_to_the_last_one(spark):
    with scratch(spark):
        house = Warehouse(spark, sources(spark)).settle("dim_users")
        assert spark.range(1).select(house.last_version).first()[0] == D(2024, 3, 1)


def test_sales_are_stored_by_product(spark, sf_dir, no_broadcast):
    with scratch(spark):
        text = plan(entry.queries()["rpt_transactions"](spark, sf_dir))
        by_product = [part for keys, part in shuffles(text) if keys[0] == "product_id"]
        assert not any("session_id" in part for part in by_product)


def test_activity_mart_with_stored_products_is_the_same(spark):
    src = sources(spark)
    unit = src["transactionsanditems"].where("item_id = 1001").withColumns(
        {"item_id": F.lit(None).cast("string"), "product_id": F.lit(None).cast("string")}
    )
    src["transactionsanditems"] = src["transactionsanditems"].unionByName(unit)
    # a product of another brand with an id that is there already: each of its units is two rows, one event
    again = src["productattributes"].where("item_id = 2").withColumn("item_brand", F.lit("Other"))
    src["productattributes"] = src["productattributes"].unionByName(again)
    for events_name, name in (
        ("listed_events", "rpt_customer_activity"),
        ("listed_events_as_of", "rpt_customer_activity_as_of"),
    ):
        with scratch(spark):
            lazy = getattr(Warehouse(spark, src), name)
            stored = getattr(Warehouse(spark, src).settle("dim_users", events_name), name)
            assert stored.columns == lazy.columns and stored.count() == lazy.count() == 7
            assert stored.agg(F.countDistinct("customer_activity_sequence")).first()[0] == 6
            assert stored.exceptAll(lazy).isEmpty()
