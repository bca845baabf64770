"""Operators on small frames with hand-computed results."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillstar.functions.keys import conformed_key
from tillstar.operators.joins import left_lookup, orphans
from tillstar.operators.numbering import dense_key
from tillstar.operators.reshape import explode_units
from tillstar.operators.scd import as_of_join, current, scd2_apply, scd2_from_versions
from tillstar.operators.sequences import running_counts, running_totals, sequence_events
from tillstar.operators.sessions import page_view_kinds_metrics, session_metrics
from tillstar.plans import staging

D = dt.date


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_unpivot_drops_empty_cells(spark):
    platforms = staging.AD_PLATFORMS
    wide = {f"{p}_{m}": None for p in platforms for m in ("impressions", "clicks", "cost")}
    wide |= {"google_impressions": 10, "google_clicks": 2, "google_cost": 5.0}
    wide |= {"meta_impressions": 0, "meta_clicks": 0, "meta_cost": 0.0, "tiktok_cost": 1.0}
    schema = "date date, " + ", ".join(
        f"{p}_impressions bigint, {p}_clicks bigint, {p}_cost double" for p in platforms
    )
    names = [f"{p}_{m}" for p in platforms for m in ("impressions", "clicks", "cost")]
    src = spark.createDataFrame([(D(2024, 1, 1), *[wide[n] for n in names])], schema)
    long = staging.ad_platform_unpivoted(staging.ad_platform(src))
    assert rows(long.select("ad_platform", "impressions", "clicks", "cost", "cpc"), "ad_platform") == [
        ("google", 10, 2, 5.0, 2.5), ("tiktok", None, None, 1.0, None),
    ]


def test_session_collapse(spark):
    schema = (
        "session_id string, date date, city string, device_category string, "
        "traffic_medium string, traffic_source string, user_cookie_id string, customer_id string"
    )
    src = spark.createDataFrame(
        [
            ("s1", D(2024, 1, 1), None, "mobile", "cpc", "YouTube", "c1", "7"),
            ("s1", D(2024, 1, 2), "Paris", "mobile", "cpc", "google", "c1", "x"),
            (" ", D(2024, 1, 2), "Rome", None, None, None, None, None),
        ],
        schema,
    )
    [one] = staging.sessions(src).collect()
    assert (one.session_id, one.start_date, one.end_date) == ("s1", D(2024, 1, 1), D(2024, 1, 2))
    assert (one.session_count, one.city, one.traffic_source, one.customer_id) == (
        2, "Paris", "google", 7
    )


def _events(spark):
    sessions = {
        "a": ["page_view"],
        "b": ["page_view", "view_item"],
        "c": ["view_item"],
        "d": ["page_view", "page_view"],
    }
    data = [
        (s, name, dt.datetime(2024, 1, 1, 0, 0, 10 * i))
        for s, names in sessions.items()
        for i, name in enumerate(names)
    ]
    return spark.createDataFrame(data, "session_id string, event_name string, event_time timestamp_ntz")


def test_bounce_is_a_single_page_view(spark):
    got = rows(
        session_metrics(_events(spark)).select(
            "session_id", "page_views", "bounce_flag", "session_duration"
        ),
        "session_id",
    )
    assert got == [
        ("a", 1, True, 0), ("b", 1, False, 10), ("c", 0, False, 0), ("d", 2, False, 10)
    ]


def test_page_view_kinds(spark):
    got = rows(
        page_view_kinds_metrics(_events(spark)).select("session_id", "page_views", "bounce_flag"),
        "session_id",
    )
    assert got == [("a", 1, True), ("b", 2, False), ("c", 1, True), ("d", 1, True)]


def test_versions_with_a_tie(spark):
    src = spark.createDataFrame(
        [(1, D(2024, 1, 1), "a"), (1, D(2024, 2, 1), "b"), (1, D(2024, 2, 1), "c")],
        "k bigint, valid_from date, v string",
    )
    got = scd2_from_versions(src, ["k"], "valid_from").collect()
    assert sorted((r.valid_from, r.valid_to or D.max, r.is_current) for r in got) == [
        (D(2024, 1, 1), D(2024, 2, 1), False),
        (D(2024, 2, 1), D(2024, 2, 1), False),
        (D(2024, 2, 1), D.max, True),
    ]
    assert current(scd2_from_versions(src, ["k"], "valid_from")).count() == 1


@pytest.mark.parametrize("how", ["left", "inner"])
def test_as_of_join_is_half_open(spark, how):
    dim = spark.createDataFrame(
        [(1, D(2024, 1, 10), D(2024, 2, 10), "v1"), (1, D(2024, 2, 10), None, "v2")],
        "k bigint, valid_from date, valid_to date, v string",
    )
    days = [D(2024, 1, 9), D(2024, 1, 10), D(2024, 2, 9), D(2024, 2, 10)]
    fact = spark.createDataFrame(
        [(i, 1, d) for i, d in enumerate(days)] + [(9, None, D(2024, 3, 1))],
        "id bigint, k bigint, day date",
    )
    got = rows(as_of_join(fact, dim, "k", "day", how, spread_by="id").select("id", "v"), "id")
    found = [(1, "v1"), (2, "v1"), (3, "v2")]
    assert got == ([(0, None), *found, (9, None)] if how == "left" else found)


def test_snapshot_changes(spark):
    history = spark.createDataFrame(
        [
            (1, "old", D(2024, 1, 1), None, True),
            (2, "same", D(2024, 1, 1), None, True),
            (3, "gone", D(2024, 1, 1), None, True),
            (4, "closed", D(2024, 1, 1), D(2024, 2, 1), False),
            (6, None, D(2024, 1, 1), None, True),
        ],
        "k bigint, v string, valid_from date, valid_to date, is_current boolean",
    )
    snapshot = spark.createDataFrame(
        [(1, "new"), (2, "same"), (4, "back"), (5, "first"), (6, None)], "k bigint, v string"
    )
    day = D(2024, 3, 1)
    got = rows(scd2_apply(history, snapshot, ["k"], ["v"], F.lit(day)), "k", "valid_from")
    assert got == [
        (1, "old", D(2024, 1, 1), day, False),
        (1, "new", day, None, True),
        (2, "same", D(2024, 1, 1), None, True),
        (3, "gone", D(2024, 1, 1), day, False),
        (4, "closed", D(2024, 1, 1), D(2024, 2, 1), False),
        (4, "back", day, None, True),
        (5, "first", day, None, True),
        (6, None, D(2024, 1, 1), None, True),
    ]
    kept = scd2_apply(history, snapshot, ["k"], ["v"], F.lit(day), close_deleted=False)
    assert kept.where("k = 3").first().is_current
    again = scd2_apply(
        scd2_apply(history, snapshot, ["k"], ["v"], F.lit(day)), snapshot, ["k"], ["v"],
        F.lit(D(2024, 4, 1)),
    )
    assert rows(again, "k", "valid_from") == got


def test_units_have_their_own_keys(spark):
    lines = spark.createDataFrame([("l1", 3), ("l2", 1), ("l3", 0)], "line string, qty bigint")
    units = explode_units(lines, "qty", "unit_id", ["line"])
    got = units.collect()
    assert len(got) == 4 and len({r.unit_id for r in got}) == 4
    assert {r.qty for r in got} == {1}


def test_dense_key_equals_row_number(spark):
    towns = [
        ("US", None, "Austin"), ("US", "TX", "Austin"), ("US", "MN", "Austin"),
        ("US", "TX", "Aurora"), ("US", None, "Boston"), ("US", "TX", "a"), ("US", "TX", "Å"),
    ]
    df = spark.createDataFrame(towns, "country string, region string, city string")
    got = rows(dense_key(df, "n", ["country", "region", "city"]), "n")
    plain = df.select(
        F.row_number().over(Window.orderBy("country", "region", "city")).alias("n"), "*"
    )
    assert got == rows(plain, "n")


def test_sequence_of_a_hot_key_equals_plain_window(spark):
    """One customer owns most events; many share a day."""
    events = spark.range(3000).select(
        F.col("id"),
        F.when(F.col("id") % 3 > 0, F.lit(1)).otherwise(F.col("id") % 17).alias("k"),
        F.date_add(F.lit(D(2023, 11, 20)), (F.col("id") * 7919 % 200).cast("int")).alias("day"),
    )
    got = sequence_events(events, "k", "day", ["id"])
    w = Window.partitionBy("k").orderBy("day", "id")
    plain = events.select(
        "*",
        F.min("day").over(Window.partitionBy("k")).alias("first_day"),
        F.row_number().over(w).cast("bigint").alias("sequence"),
        F.lag("day").over(w).alias("prev_day"),
    )
    names = ["id", "k", "day", "sequence", "prev_day", "first_day"]
    assert rows(got.select(names), "id") == rows(plain.select(names), "id")


def test_sequence_of_a_busy_day_equals_plain_window(spark):
    """Most events fall on one day of one key; the first tie is null on some rows."""
    events = spark.range(2000).select(
        F.col("id"),
        F.when(F.col("id") % 5 > 0, F.lit(1)).otherwise(F.col("id") % 7).alias("k"),
        F.date_add(F.lit(D(2024, 1, 1)), (F.col("id") % 11 / 10).cast("int")).alias("day"),
        F.when(F.col("id") % 9 == 0, "a").otherwise("b").alias("kind"),
        F.when(F.col("id") % 9 > 0, F.col("id") % 40).alias("order"),
    )
    got = sequence_events(events, "k", "day", ["kind", "order", "id"])
    w = Window.partitionBy("k").orderBy("day", "kind", "order", "id")
    plain = events.select(
        "*",
        F.min("day").over(Window.partitionBy("k")).alias("first_day"),
        F.row_number().over(w).cast("bigint").alias("sequence"),
        F.lag("day").over(w).alias("prev_day"),
    )
    names = ["id", "k", "day", "kind", "order", "sequence", "prev_day", "first_day"]
    assert rows(got.select(names), "id") == rows(plain.select(names), "id")


def test_last_day_finds_the_open_version(spark):
    dim = spark.createDataFrame(
        [(1, D(2024, 1, 1), None, "x")], "k bigint, valid_from date, valid_to date, city string"
    )
    fact = spark.createDataFrame([(1, D(9999, 12, 31))], "k bigint, day date")
    for how in ("left", "inner"):
        assert as_of_join(fact, dim, "k", "day", how).first().city == "x"


def test_sums_keep_fractions_of_a_cent(spark):
    from tillstar.functions.numbers import money_sum
    from tillstar.plans import exports

    ads = spark.range(1000).select(
        F.lit("google").alias("ad_platform"), F.lit(D(2024, 1, 10)).alias("date"),
        F.lit(0.004).alias("cost"), F.lit(1).alias("clicks"), F.lit(2).alias("impressions"),
    )
    assert ads.agg(money_sum(F.col("cost"))).first()[0] == 4.0
    week = exports.weekly_ad_spend(ads).first()
    assert (week.weekly_cost, week.weekly_cpc) == (4.0, 0.004)


def test_running_totals_include_the_day(spark):
    marks = spark.createDataFrame(
        [(1, D(2024, 1, 1)), (1, D(2024, 1, 5)), (2, D(2024, 1, 1))], "k bigint, day date"
    )
    amounts = spark.createDataFrame(
        [(1, D(2024, 1, 1), 2.5), (1, D(2024, 1, 3), 1.0), (1, D(2024, 1, 9), 9.0)],
        "k bigint, day date, v double",
    )
    got = rows(running_totals(marks, amounts, "k", "day", ["v"]), "k", "day")
    assert [(k, d, None if v is None else float(v)) for k, d, v in got] == [
        (1, D(2024, 1, 1), 2.5), (1, D(2024, 1, 5), 3.5), (2, D(2024, 1, 1), None)
    ]


def test_lookup_keeps_rows_without_key(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "z")], "id bigint, k string")
    right = spark.createDataFrame([("a", 10)], "k string, v bigint")
    got = rows(left_lookup(left, right, "k", spread_by="id"), "id")
    assert got == [(1, "a", 10), (2, None, None), (3, "z", None)]


def test_lookup_null_safe_column(spark):
    left = spark.createDataFrame(
        [(1, "Austin", None), (2, "Austin", "TX"), (3, None, None)],
        "id bigint, town string, area string",
    )
    right = spark.createDataFrame(
        [("Austin", None, 1), ("Austin", "TX", 2), ("Austin", "MN", 3)],
        "town string, area string, key bigint",
    )
    got = left_lookup(left, right, ["town", "area"], spread_by="id", null_safe=["area"])
    assert rows(got.select("id", "key"), "id") == [(1, 1), (2, 2), (3, None)]


def test_orphans_count_rows_per_key(spark):
    child = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    parent = spark.createDataFrame([("a",)], "k string")
    assert rows(orphans(child, "k", parent, "k"), "key") == [("b", 2)]


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("months, until", [(1, None), (12, None), (5, D(2023, 5, 5)), (12, D(1999, 1, 1))])
def test_as_of_join_equals_the_interval_join(spark, how, months, until):
    draw = random.Random(months)
    day = lambda: D(2021, 1, 1) + dt.timedelta(draw.randrange(1500))
    versions, facts = [], [(i, draw.choice([1, 2, 3, 4, None]), draw.choice([day(), day(), day(), None])) for i in range(400)]
    facts += [(900, 1, D(1900, 1, 1)), (901, 1, D(9999, 12, 31)), (902, 3, D(9999, 12, 31))]
    for k in (1, 2, 3, 5, None):
        starts = sorted({day() for _ in range(12)})
        ends = [*starts[1:], None if k != 3 else starts[-1] + dt.timedelta(3)]
        versions += [(k, a, b, f"{k}-{a}") for a, b in zip(starts, ends)]
    versions += [(1, D(2022, 1, 1), D(2022, 1, 1), "empty"), (2, None, D(2022, 1, 1), "undated")]
    dim = spark.createDataFrame(versions, "k bigint, valid_from date, valid_to date, v string")
    fact = spark.createDataFrame(facts, "id bigint, k bigint, day date")
    joined = as_of_join(
        fact, dim, "k", "day", how, "id", months, None if until is None else F.lit(until)
    )
    expected = []
    for i, k, d in facts:
        hits = [
            v for vk, a, b, v in versions
            if k is not None and vk == k and d is not None and a is not None
            and a <= d and (b is None or d < b)
        ]
        expected += [(i, v) for v in hits or ([None] if how == "left" else [])]
    assert joined.columns == ["id", "k", "day", "v"]
    got = [tuple(r) for r in joined.select("id", "v").collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_a_key_with_very_many_versions_and_facts_is_many_tasks(spark):
    """100,000 versions of one customer, a new one every day, and a third of all facts."""
    start = D(1750, 1, 1)
    dim = spark.range(100_000).select(
        F.lit(0).cast("long").alias("k"),
        F.date_add(F.lit(start), F.col("id").cast("int")).alias("valid_from"),
        F.date_add(F.lit(start), F.col("id").cast("int") + 1).alias("valid_to"),
        F.col("id").alias("v"),
    )
    fact = spark.range(90_000).select(
        "id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        F.date_add(F.lit(start), (F.col("id") % 100_000).cast("int")).alias("day"),
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = as_of_join(fact, dim, "k", "day", months=1).where("k = 0")
        per_task = joined.groupBy(F.spark_partition_id().alias("task")).agg(
            F.count("*").alias("n"), F.count_if(F.col("v") == F.col("id")).alias("right")
        ).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sum(r.n for r in per_task) == sum(r.right for r in per_task) == 30_000
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(per_task) == tasks and max(r.n for r in per_task) < 2 * 30_000 / tasks


def test_dense_key_reads_its_input_once(spark, tmp_path):
    df = spark.range(5000).select((F.col("id") % 1700).cast("string").alias("v")).distinct()
    numbered = dense_key(df, "n", ["v"])
    text = numbered._jdf.queryExecution().optimizedPlan().toString()
    assert "Range" not in text  # what is stored is read, the input isn't
    plain = df.select(F.row_number().over(Window.orderBy("v")).cast("bigint").alias("n"), "v")
    assert rows(numbered, "n") == rows(plain, "n")
    assert numbered.columns == ["n", "v"] and dense_key(df.limit(0), "n", ["v"]).count() == 0
    whole = dense_key(spark.range(100).select((100 - F.col("id")).alias("k")), "n", ["k"])
    assert [(r.n, r.k) for r in whole.orderBy("n").collect()] == [(i, i) for i in range(1, 101)]


def test_large_lines_are_exploded_in_blocks(spark):
    lines = [(f"l{k}", q) for k, q in enumerate([0, 1, 7, 8, 9, 16, 17, 100, None, -3])]
    df = spark.createDataFrame(lines, "line string, qty bigint")
    whole = rows(explode_units(df, "qty", "unit_id", ["line"]), "line", "unit_no")
    parts = rows(explode_units(df, "qty", "unit_id", ["line"], block=8), "line", "unit_no")
    assert whole == parts and len(whole) == 158 and len({r[-1] for r in whole}) == 158
    one = spark.createDataFrame([("big", 10_000_000)], "line string, qty bigint").coalesce(1)
    units = explode_units(one, "qty", "unit_id", ["line"])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = units.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r.n for r in tasks) == 10_000_000
    assert len(tasks) > 3 and max(r.n for r in tasks) < 5_000_000


def test_unit_keys_join_the_text_of_a_line_once(spark):
    texts = ["", "a", "é|ü", "x" * 300, None]
    lines = [(t, n, q) for t in texts for n in (7, None) for q in (1, 9, 10, 101)] * 2
    df = spark.createDataFrame([*lines, ("a", 7, 1234), ("a", 7, 0)], "a string, b bigint, qty int")
    for block in (1000, 16):
        units = explode_units(df, "qty", "unit_id", ["a", "b"], block)
        assert units.columns == ["a", "b", "qty", "unit_no", "unit_id"]
        same = F.col("unit_id") == conformed_key("a", "b", "unit_no")
        assert units.count() == units.where(same).count() == sum(q for *_, q in lines) + 1234
    plan = units._jdf.queryExecution().optimizedPlan().toString()
    assert "md5" in plan and "_null_" not in plan[: plan.index("Generate")]


def test_running_counts_equal_the_window(spark):
    events = spark.range(2000).select(
        "id", F.when(F.col("id") % 3 > 0, 1).when(F.col("id") % 7 > 0, F.col("id") % 11).alias("k"),
        F.when(F.col("id") % 50 > 0, F.date_add(F.lit(D(2024, 1, 1)), (F.col("id") % 40).cast("int"))).alias("day"),
    )
    w = Window.partitionBy("k").orderBy("day")
    plain = events.where("k is not null").withColumn("n", F.count("*").over(w))
    got = running_counts(events, "k", "day", "n")
    assert got.columns == ["id", "k", "day", "n"]
    assert rows(got, "id") == rows(plain, "id")
