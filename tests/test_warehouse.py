"""Facts, marts and the full build on a tiny retailer with hand-computed results."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from retail import sources
from tillstar.plans import checks, exports, marts, reports, warehouse
from tillstar.operators import quality as q
from tillstar.plans.warehouse import CORE, MARTS, STAGING, Warehouse, build

D = dt.date


@pytest.fixture(scope="module")
def house(spark):
    h = Warehouse(spark, sources(spark), built_at=F.lit(D(2024, 4, 1)))
    return h.settle("dim_users", "stg_sessions", "fct_sessions", "fct_transactions",
                    "rpt_transactions", "activity_events")


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_users(house):
    versions = house.dim_users.orderBy("customer_id", "valid_from").collect()
    assert [(r.customer_id, r.plus_tier, r.is_current) for r in versions] == [
        (7, None, False), (7, "Gold", False), (7, None, True), (8, None, True)
    ]
    assert {r.customer_id: (r.lifetime_orders, r.lifetime_value) for r in versions} == {
        7: (1, 75.0), 8: (0, 0.0)
    }


def test_geo_has_one_row_per_city_and_region(house):
    rows = house.dim_geo.orderBy("geo_key").collect()
    assert [(r.geo_key, r.city, r.region) for r in rows] == [
        (1, "Austin", None), (2, "Austin", "MN"), (3, "Austin", "TX")
    ]
    assert rows[0].region_key is None and rows[1].region_key != rows[2].region_key


def test_each_session_matches_one_city_and_device(house):
    rows = by(house.fct_sessions, "session_id")
    assert len(rows) == house.fct_sessions.count() == 3
    assert [rows[s].geo_key for s in ("s1", "s2", "s3")] == [3, 1, None]
    assert all(r.device_key for r in rows.values())
    assert rows["s1"].platform_key == rows["s2"].platform_key is not None
    assert rows["s3"].platform_key is None
    assert (rows["s1"].page_views, rows["s1"].transaction_count) == (1, 2)
    assert rows["s1"].session_duration_seconds == 31
    assert rows["s2"].bounce_flag and rows["s2"].session_duration_seconds is None
    assert not rows["s3"].bounce_flag and rows["s3"].page_views == 0


def test_units_are_not_repeated(house):
    rows = by(house.fct_transactions, "item_id")
    assert house.fct_transactions.count() == 4
    first, free = rows[1001], rows[1004]
    assert first.purchase_time == "10:00:30" and first.product_contribution_pct == 13.33
    assert (first.pricing_type, first.customer_type) == ("Discount", "Registered")
    assert first.plus_status is None and first.return_date == D(2024, 1, 15)
    assert first.return_date_key == 20240115 and first.return_rate_pct == 100.0
    assert (free.pricing_type, free.customer_type) == ("Full Price", "Guest")
    assert free.product_contribution_pct is None and not free.has_return


def test_refunds_and_profit(house):
    rows = by(house.rpt_transactions, "item_id")
    assert [rows[i].refund_amount for i in (1001, 1002, 1003)] == [10.0, 0.0, 0.0]
    assert [rows[i].net_revenue for i in (1001, 1002, 1003)] == [0.0, 10.0, 50.0]
    assert rows[1003].gross_profit == 20.0 and rows[1003].product_main_category == "Shoes"
    assert rows[1001].user_city == "Austin, MN" and rows[1001].coupon_flag


def test_profile_changes(house):
    rows = house.activity_events.where("activity_type = 'profile_change'").collect()
    kinds = {r.activity_date: r.change_type for r in rows}
    assert kinds == {D(2024, 2, 1): "Location Change", D(2024, 3, 1): "Other Change"}


def test_tier_changes_with_nulls(spark):
    tiers = ["Gold", None, "Gold", "Silver"]
    dim = spark.createDataFrame(
        [
            (i, 1, dt.datetime(2024, 1, i + 1), "X", "F", True, t, True, 0, 0.0, i == 3)
            for i, t in enumerate(tiers)
        ],
        "user_key bigint, customer_id bigint, valid_from timestamp, city string, gender string, "
        "plus_status boolean, plus_tier string, opt_in_status boolean, lifetime_orders bigint, "
        "lifetime_value double, is_current boolean",
    )
    rows = marts.profile_changes(dim).orderBy("activity_date").collect()
    assert [r.change_type for r in rows] == ["Other Change", "Other Change", "Plus Tier Change"]


def test_activity_order(house):
    rows = house.rpt_customer_activity.orderBy("customer_activity_sequence").collect()
    assert [(r.activity_date, r.item_id) for r in rows] == [
        (D(2024, 1, 10), 1001), (D(2024, 1, 10), 1002), (D(2024, 1, 10), 1003),
        (D(2024, 2, 1), None), (D(2024, 3, 1), None),
    ]
    assert [r.days_since_last_activity for r in rows] == [None, 0, 0, 22, 29]
    assert [r.customer_tenure_days for r in rows] == [0, 0, 0, 22, 51]
    assert [r.customer_activity_sequence for r in rows] == [1, 2, 3, 4, 5]
    assert rows[0].customer_state_at_time == "New Customer"
    assert rows[3].customer_state_at_time == "Premium Customer"


def test_lifetime_as_of_does_not_see_the_future(house):
    dated = marts.lifetime_as_of(house.dim_users, house.stg_transactions)
    rows = dated.where("customer_id = 7").orderBy("valid_from").collect()
    assert [r.lifetime_orders for r in rows] == [0, 1, 1]
    assert [r.lifetime_value for r in rows] == [0.0, 75.0, 75.0]


def test_channel_mart_counts_an_order_once(house):
    [row] = house.rpt_daily_channel_performance.collect()
    assert (row.platform, row.channel, row.ad_spend) == ("google", "Other", 20.0)
    assert (row.sessions, row.total_users, row.new_users, row.bounces) == (2, 1, 0, 1)
    assert (row.page_views, row.avg_session_duration) == (2, 31.0)
    assert (row.transaction_count, row.total_revenue) == (1, 70.0)
    assert (row.item_quantity, row.item_price_total) == (3, 70.0)


def test_channel_window_needs_a_start(house):
    assert house.channel_performance(end=D(2020, 1, 1)).count() == 1
    assert house.channel_performance(D(2024, 1, 11)).count() == 0
    assert house.channel_performance(D(2024, 1, 1), D(2024, 1, 9)).count() == 0


def test_daily_spend(house):
    [row] = house.daily_spend_metrics.collect()
    assert (row.date_key, row.source, row.cost) == (20240110, "google", 20.0)
    assert (row.daily_transaction_total, row.conversion_rate, row.roas) == (75.0, 50.0, 375.0)


def test_signups(house):
    users = house.stg_users
    once = {r.city: r.total_signups for r in exports.weekly_signups(users).collect()}
    rows = {r.city: r.total_signups for r in exports.weekly_signups(users, True).collect()}
    assert once == {"Austin, TX": 1, "Austin, MN": 1, "Austin": 1}
    assert rows == {"Austin, TX": 1, "Austin, MN": 2, "Austin": 1}


def test_reports(house):
    profit = {
        (r.month, r.product_main_category): r
        for r in house.category_profitability.collect()
    }
    clothes = profit[(D(2024, 1, 1), "Clothes")]
    assert (clothes.units_sold, clothes.revenue, clothes.gross_profit) == (2, 20.0, 12.0)
    assert (clothes.net_revenue, clothes.gross_margin, clothes.return_rate) == (10.0, 0.6, 0.5)
    [order] = house.average_order_value.collect()
    assert tuple(order) == (2, 1, 40.0, 80.0)
    [month] = house.session_engagement.collect()
    assert (month.sessions, month.bounces, month.converting_sessions) == (3, 1, 1)
    assert reports.top_customers(house.dim_users, 1).first().customer_id == 7


def test_repeated_unit_counts_once_in_category_profitability(house):
    key = lambda r: (r.month, r.product_main_category)
    units, catalog = house.sold_units, house.product_catalog
    once = {key(r): r for r in house.category_profitability.collect()}
    twice = reports.category_profitability(units.unionAll(units), catalog).collect()
    assert {key(r): r.units_sold for r in twice} == {k: r.units_sold for k, r in once.items()}
    assert all(r.quantity == 2 * once[key(r)].quantity for r in twice)


def test_checks_pass_on_a_sound_build(house):
    frames = {n: getattr(house, n) for n in (*CORE, *MARTS)}
    report = q.check_report(frames, checks.core_rules() + checks.mart_rules()).collect()
    failed = {(r.table_name, r.check_name) for r in report if r.violations}
    # The second order names a session nobody recorded.
    assert failed == {("fct_transactions", "relationship_session_id_to_fct_sessions_session_id")}
    assert q.activity_timeline(house.rpt_customer_activity, house.dim_users).count() == 0
    assert q.scd_timeline(house.dim_users, "customer_id").count() == 0
    assert q.scd_integrity(house.dim_users, "customer_id", "dim_users").count() == 0


def test_full_build(spark, house):
    fresh = Warehouse(spark, sources(spark), built_at=F.lit(D(2024, 4, 1)))
    comments = {"fct_sessions": {"page_views": "Number of page views"}}
    built = build(fresh, "dev", "unit", comments)
    assert spark.table("unit_core.fct_transactions").count() == 4
    assert spark.table("unit_marts.rpt_transactions").count() == 4
    assert spark.table("unit_staging.stg_users").count() == 4
    assert spark.table("stg_transactions").count() == 2
    stored = built.rpt_customer_activity.drop("year_part")
    assert stored.exceptAll(house.rpt_customer_activity.select(stored.columns)).count() == 0
    window = built.channel_performance(D(2024, 1, 1), D(2024, 1, 31))
    assert window.count() == 1
    plan = window._jdf.queryExecution().executedPlan().toString()
    for table in ("fct_sessions", "fct_transactions"):
        scan = next(x for x in plan.split("FileScan") if f"unit_core.{table}" in x)
        assert "year_part" in scan.split("PartitionFilters: [")[1].split("]")[0]
    schema = spark.table("unit_core.fct_sessions").schema
    assert schema["page_views"].metadata["comment"] == "Number of page views"
    assert warehouse.STAGING is STAGING
    # A second run replaces every table.
    again = build(Warehouse(spark, sources(spark)), "dev", "unit")
    assert again.fct_transactions.count() == 4
    for name in ("unit_core", "unit_marts", "unit_staging"):
        spark.sql(f"DROP DATABASE {name} CASCADE")


def test_product_key_does_not_change_between_builds(spark):
    a = Warehouse(spark, sources(spark), built_at=F.lit(D(2024, 4, 1))).dim_products
    b = Warehouse(spark, sources(spark), built_at=F.lit(D(2024, 5, 1))).dim_products
    assert sorted(r.product_key for r in a.collect()) == sorted(r.product_key for r in b.collect())


def test_repeated_rows_of_the_sources_repeat_no_unit(spark):
    """Two headers of one order, two prices of one product, a sub-category under two mains."""
    src = sources(spark)
    for name, changes in (
        ("transactions", {"transaction_coupon": F.lit("A")}),
        ("product_listprices", {"item_list_price": F.lit(1.0)}),
        ("product_costs", {"cost_of_item": F.lit(1.0)}),
        ("productattributes", {"item_id": F.concat(F.lit("9"), "item_id"), "item_main_category": F.lit("Sport")}),
    ):
        src[name] = src[name].unionByName(src[name].withColumns(changes))
    house = Warehouse(spark, src)
    sold = house.rpt_transactions.collect()
    assert sorted(r.item_id for r in sold) == [1001, 1002, 1003, 1004]
    assert {r.product_main_category for r in sold} == {"Clothes", "Shoes"}
    assert {r.product_list_price for r in sold} == {10.0, 50.0}
    assert house.fct_transactions.count() == 4
    [order] = house.average_order_value.collect()
    assert order.total_revenue == 80.0


def test_versions_of_one_day_become_one(spark):
    src = sources(spark)
    src["users"] = src["users"].unionByName(src["users"].withColumn("city", F.lit("Aaa")))
    rows = Warehouse(spark, src).dim_users.collect()
    assert len(rows) == len({r.user_key for r in rows}) == 4
    assert "Aaa" not in {r.city for r in rows}


def test_audit_columns(spark):
    """Loaded tables carry their time; what is built from them stays the same."""
    moment = F.lit(dt.datetime(2024, 4, 1, 12))
    plain = Warehouse(spark, sources(spark), built_at=F.lit(D(2024, 4, 1)))
    dated = Warehouse(spark, sources(spark), built_at=F.lit(D(2024, 4, 1)), loaded_at=moment)
    for name in STAGING:
        row = getattr(dated, name).first()
        assert (row.updated_at, row.loaded_on) == (dt.datetime(2024, 4, 1, 12), D(2024, 4, 1)), name
    assert {r.updated_at for r in dated.dim_products.collect()} == {dt.datetime(2024, 4, 1, 12)}
    assert dated.rpt_customer_activity.where("mart_updated_at IS NULL").count() == 0
    for name in ("dim_users", "fct_sessions", "fct_transactions", "rpt_transactions",
                 "daily_spend_metrics", "weekly_signups"):
        one, two = getattr(plain, name), getattr(dated, name)
        assert one.columns == two.columns and one.exceptAll(two).count() == 0, name
