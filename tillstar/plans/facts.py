"""Facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.functions.dates import time_of_day
from tillstar.functions.keys import conformed_key, date_from_key, date_key
from tillstar.functions.numbers import percent, ratio
from tillstar.operators.joins import left_lookup
from tillstar.operators.scd import as_of_join
from tillstar.operators.sessions import session_metrics
from tillstar.plans.dims import UNKNOWN, city_and_region


def advertising(ad_numbers: DataFrame) -> DataFrame:
    """Day and platform numbers; conformed keys make it a projection without joins."""
    impressions = F.coalesce("impressions", F.lit(0).cast("bigint"))
    clicks = F.coalesce("clicks", F.lit(0).cast("bigint"))
    known = ad_numbers.where(F.col("date").isNotNull() & F.col("ad_platform").isNotNull())
    return known.select(
        conformed_key("date", "ad_platform").alias("ad_key"),
        date_key("date").alias("date_key"),
        conformed_key("ad_platform").alias("platform_key"),
        impressions.alias("impressions"),
        clicks.alias("clicks"),
        F.coalesce("cost", F.lit(0.0)).alias("cost"),
        F.when(impressions > 0, ratio(clicks, impressions)).otherwise(0.0).alias("ctr"),
    )


def sessions(
    stg_sessions: DataFrame,
    stg_events: DataFrame,
    dim_source: DataFrame,
    dim_medium: DataFrame,
    dim_geo: DataFrame,
    dim_devices: DataFrame,
    dim_ad_platform: DataFrame,
    metrics=session_metrics,
) -> DataFrame:
    """One row per session with dimension keys and event metrics.

    Sessions and metrics are both grouped by session id, so they join without
    another shuffle. `metrics` is the per-session aggregate to use.
    """
    town, area = city_and_region(F.col("city"))
    base = stg_sessions.where(F.col("session_id").isNotNull()).select(
        "session_id", "user_cookie_id",
        date_key("start_date").alias("date_key"),
        "customer_id",
        F.col("traffic_source").alias("source"),
        F.col("traffic_medium").alias("medium"),
        "device_category",
        town.alias("town"), area.alias("area"),
    )
    measured = base.join(metrics(stg_events), "session_id", "left")

    # A town without region matches only the row without region.
    places = dim_geo.select("geo_key", F.col("city").alias("town"), F.col("region").alias("area"))
    unknown_agent = (F.col("browser") == UNKNOWN) & (F.col("os") == UNKNOWN)
    device_rows = dim_devices.where(unknown_agent).select("device_category", "device_key")
    platforms = dim_ad_platform.select(
        F.lower("platform_name").alias("source_name"), "platform_key"
    )
    keyed = left_lookup(
        measured, dim_source.select("source", "source_key"), "source", spread_by="session_id"
    )
    keyed = left_lookup(
        keyed, dim_medium.select("medium", "medium_key"), "medium", spread_by="session_id"
    )
    keyed = left_lookup(keyed, device_rows, "device_category", spread_by="session_id")
    keyed = left_lookup(
        keyed.withColumn("source_name", F.lower("source")), platforms, "source_name",
        spread_by="session_id",
    )
    keyed = left_lookup(
        keyed, places, ["town", "area"], spread_by="session_id", null_safe=["area"]
    )
    bounced = F.coalesce("bounce_flag", F.lit(False))
    return keyed.select(
        "session_id", "user_cookie_id", "date_key", "customer_id", "source_key", "platform_key",
        "medium_key", "geo_key", "device_key",
        F.coalesce("page_views", F.lit(0).cast("bigint")).alias("page_views"),
        F.coalesce(F.col("add_to_cart_flag") == 1, F.lit(False)).alias("add_to_cart_flag"),
        bounced.alias("bounce_flag"),
        F.coalesce("transaction_count", F.lit(0).cast("bigint")).alias("transaction_count"),
        F.when(~bounced, F.col("session_duration")).alias("session_duration_seconds"),
    )


def returns_per_item(stg_returns: DataFrame) -> DataFrame:
    """One return per unit: the latest, with all returned quantity."""
    latest = F.struct("return_date", "return_status")
    return (
        stg_returns.where(F.col("item_id").isNotNull())
        .groupBy("item_id")
        .agg(F.max(latest).alias("last"), F.sum("return_quantity").alias("return_quantity"))
        .select("item_id", "last.return_status", "last.return_date", "return_quantity")
    )


def purchase_times(stg_events: DataFrame) -> DataFrame:
    """First event of each product within a transaction."""
    linked = stg_events.where(F.col("transaction_id").isNotNull() & F.col("item_id").isNotNull())
    return linked.groupBy("transaction_id", F.col("item_id").alias("product_id")).agg(
        F.min("event_time").alias("event_time")
    )


HEADER = [
    "user_cookie_id", "customer_id", "session_id", "transaction_coupon", "transaction_revenue",
    "transaction_shipping", "transaction_total",
]


def unit_rows(
    stg_items: DataFrame,
    stg_transactions: DataFrame,
    stg_returns: DataFrame,
    stg_events: DataFrame,
    customers: DataFrame | None = None,
    header_to: str = HEADER[-1],
) -> DataFrame:
    """One row per unit sold with its order, purchase time and return, nothing derived yet.

    With `customers`, orders meet their customer before the units meet the order, so that the
    units needn't be shuffled by customer; its columns are added. Columns of the header after
    `header_to` are left out; as headers are compared from the first column on, that
    doesn't change which values the others have.

    Order header, purchase times and return are each grouped to one row per key before
    they join, so a unit is never repeated; and since their keys are known to be
    distinct, Catalyst drops the joins whose columns nobody reads. Of headers that
    repeat an id the largest stays. Units carry an order and an id of their own, so
    neither join spreads missing keys: header and times both find the units
    partitioned by order. The return comes first, while units are narrow; the units of an
    order then stay side by side, so the columns of its header pack well in a later shuffle.
    """
    items = stg_items.select(
        "item_id", "transaction_id", "product_id", date_key("date").alias("date_key"),
        "product_price", "product_quantity",
    )
    header = F.struct(
        *HEADER[: HEADER.index(header_to) + 1], F.lit(True).alias("has_header")
    )
    headers = (
        stg_transactions.where(F.col("transaction_id").isNotNull())
        .groupBy("transaction_id")
        .agg(F.max(header).alias("header"))
        .select("transaction_id", "header.*")
    )
    if customers is not None:
        headers = left_lookup(headers, customers, "customer_id", spread_by="transaction_id")
    # only orders with a header show times; meeting their ids leaves the events by order, so that
    # neither of the two groupings needs a shuffle of its own
    orders = stg_transactions.where(F.col("transaction_id").isNotNull()).select("transaction_id")
    times = (
        purchase_times(stg_events.join(orders, "transaction_id", "left_semi"))
        .groupBy("transaction_id")
        .agg(F.map_from_entries(F.collect_list(F.struct("product_id", "event_time"))).alias("times"))
    )
    rows = left_lookup(items, returns_per_item(stg_returns), "item_id")
    rows = left_lookup(rows, headers, "transaction_id")
    rows = left_lookup(rows, times, "transaction_id")
    moment = F.try_element_at("times", F.col("product_id"))
    # the time of day alone, as the day would fill later shuffles
    return rows.withColumn(
        "purchase_time", F.when(F.col("has_header"), time_of_day(moment))
    ).drop("times", "has_header")


def revenue() -> Column:
    return F.round(F.col("product_price") * F.col("product_quantity"), 2)


def described(rows: DataFrame, added: Sequence[str] = ()) -> DataFrame:
    """Units (`unit_rows`) with the amounts and labels that follow from their columns, and
    the `added` columns at the end.

    Apply it after the joins, so that no shuffle carries what can be computed.
    """
    returned = F.coalesce("return_quantity", F.lit(0.0))
    return rows.select(
        "item_id", "date_key",
        "customer_id", "user_cookie_id", "product_id", "transaction_id",
        "purchase_time", "session_id", "product_price", "product_quantity", revenue().alias("product_revenue"),
        "transaction_revenue", "transaction_shipping", "transaction_total", "transaction_coupon",
        percent(revenue(), F.col("transaction_total")).alias("product_contribution_pct"),
        F.when(F.col("transaction_coupon").isNotNull(), "Discount")
        .otherwise("Full Price")
        .alias("pricing_type"),
        F.when(F.col("customer_id").isNotNull(), "Registered")
        .otherwise("Guest")
        .alias("customer_type"),
        "return_status", "return_quantity", "return_date",
        date_key("return_date").alias("return_date_key"),
        F.col("return_status").isNotNull().alias("has_return"),
        F.when(F.col("product_quantity") > 0, percent(returned, F.col("product_quantity")))
        .otherwise(0.0)
        .alias("return_rate_pct"),
        *added,
    )


def member_days(rows: DataFrame, dim_users: DataFrame, until: Column | None = None) -> DataFrame:
    """The days of each order's units on which its customer was a member, as an array."""
    members = dim_users.where("plus_status").select("customer_id", "valid_from", "valid_to")
    days = rows.where(
        F.col("transaction_id").isNotNull() & F.col("customer_id").isNotNull()
    ).select("transaction_id", "customer_id", "date_key").distinct()
    held = as_of_join(
        days, members, "customer_id", date_from_key("date_key"), "inner", until=until
    )
    return held.groupBy("transaction_id").agg(F.collect_set("date_key").alias("member_days"))


def transactions(
    rows: DataFrame, dim_users: DataFrame, until: Column | None = None
) -> DataFrame:
    """Units sold (`unit_rows`), described, with the membership of the customer on the day of sale.

    An order has one customer, so orders take the days of their units to the customer versions and
    the units stay where their order is. `until` as in `as_of_join`.
    """
    joined = left_lookup(rows, member_days(rows, dim_users, until), "transaction_id")
    member = F.when(F.array_contains("member_days", F.col("date_key")), F.lit("true"))
    return described(joined.withColumn("plus_status", member), ["plus_status"])
