"""Session collapse and per-session event metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.functions.dates import seconds_between

SESSION_ATTRIBUTES = [
    "user_cookie_id", "customer_id", "city", "traffic_source", "traffic_medium", "device_category",
]


def collapse_sessions(df: DataFrame) -> DataFrame:
    """One row per session id from rows that may span several dates.

    An attribute with differing values takes the smallest, so the result does
    not depend on row order. Combines on the map side before the one shuffle.
    """
    return df.groupBy("session_id").agg(
        F.min("date").alias("start_date"),
        F.max("date").alias("end_date"),
        F.count("*").alias("session_count"),
        *[F.min(c).alias(c) for c in SESSION_ATTRIBUTES],
    )


def _is(name: str) -> Column:
    return F.col("event_name") == name


def session_metrics(events: DataFrame) -> DataFrame:
    """Counts, cart flag, purchases, bounce and duration of each session, in one aggregate.

    A bounce is a session whose only event is a page view.
    """
    totals = (
        events.where(F.col("session_id").isNotNull())
        .groupBy("session_id")
        .agg(
            F.count("*").alias("events"),
            F.count_if(_is("page_view")).alias("page_views"),
            F.max(F.when(_is("add_to_cart"), 1).otherwise(0)).alias("add_to_cart_flag"),
            F.count_if(_is("purchase")).alias("transaction_count"),
            seconds_between(F.min("event_time"), F.max("event_time")).alias("session_duration"),
        )
    )
    bounce = (F.col("events") == 1) & (F.col("page_views") == 1)
    return totals.withColumn("bounce_flag", bounce)


def page_view_kinds_metrics(events: DataFrame) -> DataFrame:
    """`session_metrics` with the older page-view measure.

    Here `page_views` is the number of kinds of event (page view or not) seen in
    the session, 1 or 2, and a bounce is a session of one kind without cart or
    purchase. Kept for dashboards built on those figures.
    """
    is_view = F.when(_is("page_view"), 1).otherwise(0)
    kinds = (
        events.where(F.col("session_id").isNotNull())
        .groupBy("session_id")
        .agg(
            F.count("*").alias("events"),
            (F.max(is_view) - F.min(is_view) + 1).cast("bigint").alias("page_views"),
            F.max(F.when(_is("add_to_cart"), 1).otherwise(0)).alias("add_to_cart_flag"),
            F.count_if(_is("purchase")).alias("transaction_count"),
            seconds_between(F.min("event_time"), F.max("event_time")).alias("session_duration"),
        )
    )
    bounce = (
        (F.col("page_views") == 1)
        & (F.col("add_to_cart_flag") == 0)
        & (F.col("transaction_count") == 0)
    )
    return kinds.withColumn("bounce_flag", bounce)
