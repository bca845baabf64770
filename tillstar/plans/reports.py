"""Business questions over the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.functions.dates import month_start
from tillstar.functions.keys import date_from_key
from tillstar.functions.numbers import MONEY, money_sum, ratio
from tillstar.operators.joins import left_lookup


def monthly_channel_performance(rpt_channel: DataFrame) -> DataFrame:
    totals = rpt_channel.groupBy(month_start(F.col("date")).alias("month"), "channel").agg(
        money_sum(F.col("ad_spend")).alias("ad_spend"),
        F.sum("sessions").alias("sessions"),
        F.sum("new_users").alias("new_users"),
        F.sum("transaction_count").alias("transactions"),
        money_sum(F.col("total_revenue")).alias("revenue"),
    )
    return totals.select(
        "*",
        ratio(F.col("transactions"), F.col("sessions")).alias("conversion_rate"),
        ratio(F.col("revenue"), F.col("ad_spend")).alias("roas"),
    )


def category_profitability(units: DataFrame, catalog: DataFrame) -> DataFrame:
    """Monthly units, revenue, profit and returns per main category.

    `catalog` is `marts.product_catalog`. A unit counts once in a month and category, however
    often its row is repeated: rows are summed per unit first, so no distinct count is planned.
    """
    refund = F.when(
        F.col("return_status") == "Refund",
        F.col("product_price") * F.coalesce("return_quantity", F.lit(0.0)),
    ).otherwise(F.lit(0.0))
    revenue, returned = F.col("product_revenue"), F.col("return_status").isNotNull()
    products = catalog.select(
        "product_id", F.col("main_category_name").alias("product_main_category"),
        F.col("unit_cost").cast(MONEY).alias("unit_cost"),
    )
    sold = units.select(
        "item_id", "product_id", "date_key", "product_quantity",
        revenue.cast(MONEY).alias("revenue"), (revenue - refund).cast(MONEY).alias("net_revenue"),
        returned.alias("returned"),
    )
    named = left_lookup(sold, products, "product_id", spread_by="date_key")
    cost = (F.col("unit_cost") * F.col("product_quantity")).cast("decimal(38,6)")
    each = named.groupBy(
        month_start(date_from_key("date_key")).alias("month"), "product_main_category", "item_id"
    ).agg(
        F.sum("product_quantity").alias("quantity"),
        F.sum("revenue").alias("revenue"),
        F.sum(F.col("revenue") - cost).alias("gross_profit"),
        F.sum("net_revenue").alias("net_revenue"),
        F.count_if("returned").alias("returned_units"),
        F.count("*").alias("rows"),
    )
    totals = each.groupBy("month", "product_main_category").agg(
        F.count("item_id").alias("units_sold"),
        F.sum("quantity").alias("quantity"),
        *[F.sum(c).cast("double").alias(c) for c in ("revenue", "gross_profit", "net_revenue")],
        *[F.sum(c).alias(c) for c in ("returned_units", "rows")],
    )
    return totals.select(
        "month", "product_main_category", "units_sold", "quantity", "revenue", "gross_profit",
        "net_revenue",
        ratio(F.col("gross_profit"), F.col("revenue")).alias("gross_margin"),
        "returned_units",
        ratio(F.col("returned_units"), F.col("rows")).alias("return_rate"),
    )


def average_order_value(units: DataFrame) -> DataFrame:
    """Orders, buyers, mean order value and revenue, from units summed to orders."""
    orders = units.groupBy("transaction_id", "customer_id").agg(
        F.sum(F.col("product_revenue").cast(MONEY)).alias("order_revenue")
    )
    buyers = orders.groupBy("customer_id").agg(
        F.count("*").alias("orders"), F.sum("order_revenue").alias("revenue"),
        F.count("order_revenue").alias("priced"),
    )
    total = F.sum("revenue").cast("double")
    return buyers.agg(
        F.sum("orders").alias("orders"),
        F.count("customer_id").alias("purchasing_customers"),
        F.round(ratio(total, F.sum("priced")), 2).alias("avg_order_value"),
        F.round(total, 2).alias("total_revenue"),
    )


def activity_mix(events: DataFrame) -> DataFrame:
    """Monthly events and customers by kind of activity and customer state.

    It takes the events (`marts.activity_events`), as neither their order nor the catalog plays a
    part. Customers are first told apart where their events are.
    """
    known = events.where(F.col("customer_id").isNotNull() & F.col("activity_date").isNotNull())
    return known.groupBy(
        month_start(F.col("activity_date")).alias("month"), "activity_type",
        "customer_state_at_time",
    ).agg(F.count("*").alias("events"), F.countDistinct("customer_id").alias("customers"))


def top_customers(dim_users: DataFrame, n: int = 100) -> DataFrame:
    """Current customers of the highest lifetime value, ties by id."""
    return (
        dim_users.where(F.col("is_current"))
        .select("customer_id", "plus_status", "plus_tier", "lifetime_orders", "lifetime_value")
        .orderBy(F.desc("lifetime_value"), "customer_id")
        .limit(n)
    )


def session_engagement(fct_sessions: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Monthly bounce rate, duration and conversion of sessions."""
    daily = fct_sessions.groupBy("date_key").agg(
        F.count("*").alias("sessions"),
        F.count_if("bounce_flag").alias("bounces"),
        F.sum("session_duration_seconds").alias("duration"),
        F.count("session_duration_seconds").alias("timed"),
        F.sum("page_views").alias("page_views"),
        F.count_if(F.col("transaction_count") > 0).alias("converting"),
    )
    monthly = (
        daily.join(dim_date.select("date_key", "date"), "date_key")
        .groupBy(month_start(F.col("date")).alias("month"))
        .agg(*[F.sum(c).alias(c) for c in daily.columns if c != "date_key"])
    )
    return monthly.select(
        "month", "sessions", "bounces",
        ratio(F.col("bounces"), F.col("sessions")).alias("bounce_rate"),
        F.round(ratio(F.col("duration"), F.col("timed")), 1).alias("avg_duration_seconds"),
        "page_views",
        F.col("converting").alias("converting_sessions"),
        ratio(F.col("converting"), F.col("sessions")).alias("session_conversion_rate"),
    )
