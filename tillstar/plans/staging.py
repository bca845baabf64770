"""Staging: typed, renamed and filtered views over the sources.

Audit columns are stamped only when a load time is given, so results can be repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.functions import classify
from tillstar.functions.numbers import (
    digits_only_int, money_sum, ratio, safe_double, safe_int, safe_round_int,
)
from tillstar.operators.reshape import any_positive, unpivot_metrics
from tillstar.operators.sessions import collapse_sessions
from tillstar.sources.schemas import AD_PLATFORMS


def audited(df: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Add `updated_at` and `loaded_on`, by default the time the query runs."""
    moment = F.current_timestamp() if loaded_at is None else loaded_at.cast("timestamp")
    return df.withColumn("updated_at", moment).withColumn("loaded_on", moment.cast("date"))


def _not_blank(name: str) -> Column:
    return F.col(name).isNotNull() & (F.trim(F.col(name)) != "")


def ad_platform(src: DataFrame) -> DataFrame:
    metrics = []
    for platform in AD_PLATFORMS:
        for count in ("impressions", "clicks"):
            name = f"{platform}_{count}"
            metrics.append(safe_round_int(F.col(name)).alias(name))
        metrics.append(safe_double(F.col(f"{platform}_cost")).alias(f"{platform}_cost"))
    return src.where(F.col("date").isNotNull()).select("date", *metrics)


def ad_platform_unpivoted(wide: DataFrame) -> DataFrame:
    """One row per day and platform with any positive number, and the cost per click."""
    long = unpivot_metrics(
        wide, ["date"], AD_PLATFORMS,
        {"impressions": "bigint", "clicks": "bigint", "cost": "double"}, "ad_platform",
    )
    return long.where(any_positive("impressions", "clicks", "cost")).withColumn(
        "cpc", ratio(F.col("cost"), F.col("clicks"))
    )


def funnel_events(src: DataFrame) -> DataFrame:
    return src.where(F.col("date").isNotNull()).select(
        F.col("date").try_cast("date").alias("date"),
        "event_time", "user_cookie_id",
        safe_int(F.col("customer_id")).alias("customer_id"),
        "session_id", "device_category", "event_name",
        safe_int(F.col("item_id")).alias("item_id"),
        safe_int(F.col("transaction_id")).alias("transaction_id"),
    )


def product_attributes(src: DataFrame) -> DataFrame:
    return src.where(F.col("item_id").isNotNull()).select(
        "item_id", "item_brand", "item_name", "item_main_category", "item_sub_category",
        "item_gender",
    )


def product_costs(src: DataFrame) -> DataFrame:
    return src.where(F.col("item_id").isNotNull() & F.col("cost_of_item").isNotNull()).select(
        safe_int(F.col("item_id")).alias("product_id"),
        safe_double(F.col("cost_of_item")).alias("product_cost"),
    )


def product_list_prices(src: DataFrame) -> DataFrame:
    return src.where(_not_blank("item_id")).select(
        safe_int(F.col("item_id")).alias("product_id"),
        safe_double(F.col("item_list_price")).alias("list_price"),
    )


def product_returns(src: DataFrame) -> DataFrame:
    return src.where(F.col("return_date").isNotNull()).select(
        "return_date",
        safe_int(F.col("transaction_id")).alias("transaction_id"),
        safe_int(F.col("item_id")).alias("item_id"),
        safe_int(F.col("product_id")).alias("product_id"),
        safe_double(F.col("return_quantity")).alias("return_quantity"),
        "return_status",
    )


def cleaned_sessions(src: DataFrame) -> DataFrame:
    return src.where(F.col("date").isNotNull() & _not_blank("session_id")).select(
        "date", "session_id", "user_cookie_id",
        safe_int(F.col("customer_id")).alias("customer_id"),
        "city",
        classify.traffic_source(F.col("traffic_source")).alias("traffic_source"),
        F.col("traffic_medium").cast("string").alias("traffic_medium"),
        "device_category",
    )


def sessions(src: DataFrame) -> DataFrame:
    return collapse_sessions(cleaned_sessions(src))


def transactions(src: DataFrame) -> DataFrame:
    return src.where(F.col("date").isNotNull()).select(
        "date", "user_cookie_id",
        digits_only_int(F.col("customer_id")).alias("customer_id"),
        "session_id",
        safe_int(F.col("transaction_id")).alias("transaction_id"),
        "transaction_coupon",
        safe_double(F.col("transaction_revenue")).alias("transaction_revenue"),
        safe_double(F.col("transaction_shipping")).alias("transaction_shipping"),
        safe_double(F.col("transaction_total")).alias("transaction_total"),
    )


def transactions_and_items(src: DataFrame) -> DataFrame:
    return src.where(F.col("date").isNotNull()).select(
        "date",
        safe_int(F.col("item_id")).alias("item_id"),
        safe_int(F.col("transaction_id")).alias("transaction_id"),
        safe_int(F.col("product_id")).alias("product_id"),
        F.round(safe_double(F.col("item_price")), 2).alias("product_price"),
        safe_round_int(F.col("item_quantity")).alias("product_quantity"),
    )


def customer_totals(transactions_src: DataFrame) -> DataFrame:
    """Distinct orders and revenue per customer."""
    return (
        transactions_src.select(
            safe_int(F.col("customer_id")).alias("customer_id"),
            "transaction_id", "transaction_total",
        )
        .where(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.countDistinct("transaction_id").alias("transaction_count"),
            money_sum(F.col("transaction_total")).alias("total_revenue"),
        )
    )


def users(src: DataFrame, transactions_src: DataFrame) -> DataFrame:
    """Customer versions with all-time order totals; ids that are no integers are dropped."""
    key = safe_int(F.col("customer_id"))
    base = src.where(key.isNotNull()).select(
        key.alias("customer_id"),
        "city", "user_gender",
        *[
            F.col(c).try_cast("date").alias(c)
            for c in (
                "registration_date", "latest_login_date", "first_purchase_date",
                "latest_purchase_date", "valid_from",
            )
        ],
        "opt_in_status", "plus_status", "plus_tier",
    )
    joined = base.join(customer_totals(transactions_src), "customer_id", "left")
    return joined.withColumns(
        {
            "transaction_count": F.coalesce("transaction_count", F.lit(0).cast("bigint")),
            "total_revenue": F.coalesce("total_revenue", F.lit(0.0)),
        }
    )
