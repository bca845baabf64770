"""Scheduled export queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.functions.dates import sunday_week
from tillstar.functions.keys import date_from_key
from tillstar.functions.numbers import MONEY, money_sum, percent, ratio
from tillstar.operators.joins import left_lookup


def session_sources(fct_sessions: DataFrame, dim_source: DataFrame) -> DataFrame:
    """Sessions with the name of their source."""
    names = dim_source.select("source_key", "source")
    visits = fct_sessions.select("session_id", "date_key", "source_key")
    return left_lookup(visits, names, "source_key", spread_by="session_id")


def daily_sales(fct_transactions: DataFrame, sourced_sessions: DataFrame) -> DataFrame:
    """Order total and number of orders per sale day and source; an order counts once."""
    orders = fct_transactions.groupBy("transaction_id", "date_key", "session_id").agg(
        F.max("transaction_total").cast(MONEY).alias("total")
    )
    origin = sourced_sessions.select("session_id", "source")
    return (
        left_lookup(orders, origin, "session_id", spread_by="transaction_id")
        .groupBy("date_key", "source")
        .agg(
            F.sum("total").cast("double").alias("daily_transaction_total"),
            F.count("transaction_id").alias("conversions"),
        )
    )


def daily_spend_metrics(
    fct_advertising: DataFrame,
    dim_ad_platform: DataFrame,
    dim_source: DataFrame,
    fct_sessions: DataFrame,
    fct_transactions: DataFrame,
) -> DataFrame:
    """Ad numbers, sales, conversion rate and return on ad spend per day and source.

    A row needs ad numbers, at least one session and at least one sale of that
    day and source. Sessions and sales are summed to that grain before joining.
    """
    platforms = dim_ad_platform.select("platform_key", "platform_name")
    spend = (
        fct_advertising.join(platforms, "platform_key")
        .join(dim_source.select(F.col("source").alias("platform_name")), "platform_name")
        .select(
            "date_key", F.col("platform_name").alias("source"), "cost", "clicks", "impressions"
        )
    )
    sourced = session_sources(fct_sessions, dim_source)
    visits = sourced.groupBy("date_key", "source").agg(F.count("session_id").alias("session_num"))
    sales = daily_sales(fct_transactions, sourced)
    rows = spend.join(visits, ["date_key", "source"]).join(sales, ["date_key", "source"])
    return rows.select(
        "date_key", "source", "cost", "clicks", "impressions",
        F.round("daily_transaction_total", 2).alias("daily_transaction_total"),
        percent(F.col("conversions"), F.col("session_num")).alias("conversion_rate"),
        percent(F.col("daily_transaction_total"), F.col("cost")).alias("roas"),
    ).distinct()


def weekly_brand_sales(units: DataFrame, catalog: DataFrame) -> DataFrame:
    """Sales per brand and week; units are summed per product and day before they meet the
    catalog (`marts.product_catalog`)."""
    daily = units.groupBy("product_id", "date_key").agg(
        F.sum(F.col("product_revenue").cast(MONEY)).alias("revenue")
    )
    brands = catalog.select("product_id", F.col("brand_name").alias("product_brand"))
    named = left_lookup(daily, brands, "product_id", spread_by="date_key")
    day = date_from_key("date_key")
    return named.groupBy(
        "product_brand", F.year(day).alias("year"), sunday_week(day).alias("week")
    ).agg(F.sum("revenue").cast("double").alias("total_weekly_sales"))


def weekly_ad_spend(ad_numbers: DataFrame) -> DataFrame:
    """Cost with click rate and cost per click weighted over the week."""
    day = F.col("date")
    weekly = ad_numbers.groupBy(
        "ad_platform", F.year(day).alias("year"), sunday_week(day).alias("week")
    ).agg(
        money_sum(F.col("cost")).alias("cost"),
        F.sum("clicks").alias("clicks"),
        F.sum("impressions").alias("impressions"),
    )
    return weekly.select(
        "ad_platform", "year", "week",
        F.round("cost", 2).alias("weekly_cost"),
        ratio(F.col("clicks"), F.col("impressions")).alias("weekly_ctr"),
        ratio(F.col("cost"), F.col("clicks")).alias("weekly_cpc"),
    )


def weekly_signups(stg_users: DataFrame, per_version: bool = False) -> DataFrame:
    """Customers registered per city and week.

    A customer has one row per version in staging. By default each customer
    counts once per city; `per_version` counts the rows instead.
    """
    day = F.col("registration_date")
    counted = F.count("*") if per_version else F.countDistinct("customer_id")
    return (
        stg_users.where(day.isNotNull())
        .groupBy("city", F.year(day).alias("year"), sunday_week(day).alias("week"))
        .agg(counted.alias("total_signups"))
    )
