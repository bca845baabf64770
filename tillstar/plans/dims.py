"""Dimensions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.functions import classify
from tillstar.functions.dates import is_holiday, is_weekend
from tillstar.functions.keys import change_signature, conformed_key, date_key
from tillstar.functions.numbers import margin, safe_int
from tillstar.functions.text import part
from tillstar.operators.numbering import dense_key
from tillstar.operators.scd import scd2_from_versions

# Bounds of the calendar, the end not included.
CALENDAR_START = dt.date(2020, 1, 1)
CALENDAR_END = dt.date(2030, 12, 31)
HOME_COUNTRY = "US"
UNKNOWN = "Unknown"
TRACKED = ["city", "gender", "opt_in_status", "plus_status", "plus_tier"]


def date_spine(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """Every day from `start` up to but without `end`."""
    days = spark.range((end - start).days)
    return days.select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("date"))


def date(
    spark: SparkSession, start: dt.date = CALENDAR_START, end: dt.date = CALENDAR_END
) -> DataFrame:
    day = F.col("date")
    return date_spine(spark, start, end).select(
        date_key(day).alias("date_key"),
        "date",
        F.dayofweek(day).alias("day_of_week"),
        F.month(day).alias("month"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        is_weekend(day).alias("is_weekend"),
        is_holiday(day).alias("is_holiday"),
    )


def users(stg_users: DataFrame) -> DataFrame:
    """Customer versions with validity intervals; the tier counts only for members.

    Of versions that start on one day only the last is kept, so that the key is unique.
    """
    named = stg_users.where(F.col("customer_id").isNotNull()).select(
        "customer_id", "city",
        F.col("user_gender").alias("gender"),
        "opt_in_status", "plus_status",
        F.when(F.col("plus_status"), F.col("plus_tier")).alias("plus_tier"),
        "registration_date", "latest_login_date", "first_purchase_date",
        F.col("latest_purchase_date").alias("last_purchase_date"),
        F.col("transaction_count").alias("lifetime_orders"),
        F.col("total_revenue").alias("lifetime_value"),
        F.col("valid_from").cast("timestamp").alias("valid_from"),
    )
    versions = scd2_from_versions(named, ["customer_id"], "valid_from").where(
        F.col("valid_to").isNull() | (F.col("valid_to") != F.col("valid_from"))
    )
    start_day = F.col("valid_from").cast("date")
    return versions.select(conformed_key("customer_id", start_day).alias("user_key"), "*")


def user_signatures(dim_users: DataFrame) -> DataFrame:
    """Digest of the tracked attributes of each version."""
    return dim_users.select("user_key", change_signature(*TRACKED).alias("change_signature"))


def products(
    attributes: DataFrame,
    list_prices: DataFrame,
    costs: DataFrame,
    valid_from: Column | None = None,
) -> DataFrame:
    """Products with price, cost and margin; one open version each, starting at the build.

    The key hashes the product alone, so it does not change from build to build. Of
    several list prices or costs of a product the highest counts. If the attributes have an
    `updated_at`, a product has the latest of its attributes, price and cost.
    """
    start = F.current_timestamp() if valid_from is None else valid_from.cast("timestamp")
    audit = ["updated_at"] if "updated_at" in attributes.columns else []
    base = attributes.select(
        safe_int(F.col("item_id")).alias("product_id"), *audit,
        F.col("item_brand").alias("brand"),
        F.col("item_name").alias("name"),
        F.col("item_main_category").alias("main_category"),
        F.col("item_sub_category").alias("sub_category"),
        F.col("item_gender").alias("gender_target"),
    )

    def highest(df: DataFrame, amount: str) -> DataFrame:
        known = df.where(F.col("product_id").isNotNull())
        stamps = [F.max(c).alias(f"{amount}_{c}") for c in audit]
        return known.groupBy("product_id").agg(F.max(amount).alias(amount), *stamps)

    priced = base.join(highest(list_prices, "list_price"), "product_id", "left").join(
        highest(costs, "product_cost"), "product_id", "left"
    )
    list_price = F.coalesce("list_price", F.lit(0.0))
    unit_cost = F.coalesce("product_cost", F.lit(0.0))
    return priced.select(
        conformed_key("product_id").alias("product_key"),
        "product_id",
        conformed_key("brand").alias("brand_key"),
        conformed_key("main_category").alias("main_category_key"),
        conformed_key("sub_category").alias("sub_category_key"),
        "name", "gender_target",
        list_price.alias("list_price"),
        unit_cost.alias("unit_cost"),
        margin(list_price, unit_cost).alias("profit_margin"),
        start.alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
        F.lit(True).alias("is_current"),
        *[F.greatest(c, f"list_price_{c}", f"product_cost_{c}").alias(c) for c in audit],
    )


def _distinct(df: DataFrame, *columns: str) -> DataFrame:
    return df.where(F.col(columns[0]).isNotNull()).select(*columns).distinct()


def brand(attributes: DataFrame) -> DataFrame:
    return _distinct(attributes, "item_brand").select(
        conformed_key("item_brand").alias("brand_key"), F.col("item_brand").alias("brand_name")
    )


def main_category(attributes: DataFrame) -> DataFrame:
    return _distinct(attributes, "item_main_category").select(
        conformed_key("item_main_category").alias("main_category_key"),
        F.col("item_main_category").alias("main_category_name"),
    )


def sub_category(attributes: DataFrame) -> DataFrame:
    """Distinct (sub, main) pairs; a sub-category under two mains keeps both rows."""
    return _distinct(attributes, "item_sub_category", "item_main_category").select(
        conformed_key("item_sub_category").alias("sub_category_key"),
        F.col("item_sub_category").alias("sub_category_name"),
        conformed_key("item_main_category").alias("main_category_key"),
    )


def city_and_region(city: Column) -> tuple[Column, Column]:
    """Split `Town, Region`; a text without a comma has no region."""
    split = city.contains(",")
    return (
        F.when(split, part(city, ",", 0)).otherwise(city),
        F.when(split, part(city, ",", 1)),
    )


def geo_locations(stg_sessions: DataFrame, stg_users: DataFrame) -> DataFrame:
    """Distinct (city, region, country) seen in sessions or customer records."""
    town, region = city_and_region(F.col("city"))

    def places(df: DataFrame) -> DataFrame:
        filled = df.where(F.col("city").isNotNull() & (F.trim("city") != ""))
        return filled.select(
            town.alias("city"), region.alias("region"), F.lit(HOME_COUNTRY).alias("country")
        )

    return places(stg_sessions).unionByName(places(stg_users)).distinct()


def country(locations: DataFrame) -> DataFrame:
    return _distinct(locations, "country").select(
        conformed_key("country").alias("country_key"), F.col("country").alias("country_name")
    )


def region(locations: DataFrame) -> DataFrame:
    return _distinct(locations, "region", "country").select(
        conformed_key("region", "country").alias("region_key"),
        F.col("region").alias("region_name"),
        conformed_key("country").alias("country_key"),
    )


def geo(locations: DataFrame) -> DataFrame:
    """City rows; `region` is kept beside its key so sessions can match on both."""
    towns = locations.where(F.col("city").isNotNull()).select("country", "region", "city")
    return dense_key(towns, "geo_key", ["country", "region", "city"]).select(
        "geo_key", "city", "region",
        F.when(F.col("region").isNotNull(), conformed_key("region", "country")).alias(
            "region_key"
        ),
    )


def seen_values(df: DataFrame, column: str, value: str, first: str, last: str) -> DataFrame:
    """Distinct non-null values of a column with the days first and last seen."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias(value))
        .agg(F.min(first).alias("first_seen"), F.max(last).alias("last_seen"))
    )


def _session_values(stg_sessions: DataFrame, column: str, value: str) -> DataFrame:
    return seen_values(stg_sessions, column, value, "start_date", "end_date")


def source(stg_sessions: DataFrame) -> DataFrame:
    return dense_key(
        _session_values(stg_sessions, "traffic_source", "source"), "source_key", ["source"]
    )


def medium(stg_sessions: DataFrame) -> DataFrame:
    numbered = dense_key(
        _session_values(stg_sessions, "traffic_medium", "medium"), "medium_key", ["medium"]
    )
    return numbered.select(
        "medium_key", "medium",
        classify.medium_category(F.col("medium")).alias("medium_category"),
        "first_seen", "last_seen",
    )


def devices(stg_sessions: DataFrame) -> DataFrame:
    """Device categories with their standard type; browser and system are not known.

    The raw category stays in the row, since that is what sessions carry.
    """
    seen = _session_values(stg_sessions, "device_category", "device_category")
    numbered = dense_key(seen, "device_key", ["device_category"])
    return numbered.select(
        "device_key", "device_category",
        classify.device_type(F.col("device_category")).alias("device_type"),
        classify.browser(F.lit(UNKNOWN)).alias("browser"),
        classify.operating_system(F.lit(UNKNOWN)).alias("os"),
        "first_seen", "last_seen",
    )


def ad_platform(
    ad_numbers: DataFrame, channels: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """Ad platforms and their channel; `channels` replaces the built-in grouping."""
    seen = seen_values(ad_numbers, "ad_platform", "platform_name", "date", "date")
    return seen.select(
        conformed_key("platform_name").alias("platform_key"),
        "platform_name",
        classify.ad_channel(F.col("platform_name"), channels).alias("channel_type"),
        "first_seen", "last_seen",
    )
