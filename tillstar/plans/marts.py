"""Report marts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.functions.classify import customer_state
from tillstar.functions.dates import noon, sunday_week
from tillstar.functions.keys import date_from_key, date_key
from tillstar.functions.numbers import MONEY, ratio
from tillstar.operators.joins import left_lookup
from tillstar.operators.scd import as_of_join, current
from tillstar.operators.sequences import group_marks, running_totals, sequence_events


def product_catalog(
    dim_products: DataFrame,
    dim_brand: DataFrame,
    dim_sub_category: DataFrame,
    dim_main_category: DataFrame,
) -> DataFrame:
    """Current products with the names of their brand and categories.

    The chain product -> sub -> main is resolved once per product, not per fact row, and
    by the product's own main category: a sub-category under two mains repeats no product.
    """
    named = current(dim_products).select(
        "product_id", "name", "gender_target", "list_price", "unit_cost", "brand_key",
        "sub_category_key", "main_category_key",
    )
    named = left_lookup(named, dim_brand.select("brand_key", "brand_name"), "brand_key")
    subs = dim_sub_category.select("sub_category_key", "sub_category_name", "main_category_key")
    named = left_lookup(named, subs, ["sub_category_key", "main_category_key"])
    mains = dim_main_category.select("main_category_key", "main_category_name")
    return left_lookup(named, mains, "main_category_key")


def customers_now(dim_users: DataFrame) -> DataFrame:
    """Current customers with the columns that the sales mart shows."""
    return current(dim_users).select(
        "customer_id",
        F.col("city").alias("user_city"),
        F.col("gender").alias("user_gender"),
        F.col("registration_date").alias("user_registration_date"),
        F.col("lifetime_orders").alias("user_lifetime_orders"),
        F.col("lifetime_value").alias("user_lifetime_value"),
        F.col("plus_status").alias("user_plus_status"),
    )


def transactions(
    units: DataFrame,
    dim_date: DataFrame,
    dim_users: DataFrame,
    dim_products: DataFrame,
    dim_brand: DataFrame,
    dim_sub_category: DataFrame,
    dim_main_category: DataFrame,
) -> DataFrame:
    """Units sold (`facts.described`) with date, current customer, product, cost, profit
    and refund.

    Units that carry the columns of `customers_now` already don't look their customer up.
    """
    catalog = product_catalog(dim_products, dim_brand, dim_sub_category, dim_main_category)
    customers = customers_now(dim_users)
    calendar = dim_date.select(
        "date_key", "date", "year", "month", "day_of_week", "quarter", "is_weekend", "is_holiday"
    )
    # customers first, while the units of an order are side by side and their header packs well;
    # the calendar last, as it needs no shuffle and its columns would be carried through the others
    rows = units
    if "user_city" not in units.columns:
        rows = left_lookup(units, customers, "customer_id", spread_by="item_id")
    rows = left_lookup(rows, catalog, "product_id", spread_by="item_id")
    rows = left_lookup(rows, calendar, "date_key", spread_by="item_id")

    cost = F.col("unit_cost") * F.col("product_quantity")
    refund = F.when(
        F.col("return_status") == "Refund",
        F.col("product_price") * F.coalesce("return_quantity", F.lit(0.0)),
    ).otherwise(F.lit(0.0))
    return rows.select(
        "item_id", "transaction_id", "date_key", "customer_id", "user_cookie_id", "session_id",
        "product_id",
        F.col("date").alias("transaction_date"),
        F.col("year").alias("transaction_year"),
        F.col("month").alias("transaction_month"),
        F.col("day_of_week").alias("transaction_day_of_week"),
        F.col("quarter").alias("transaction_quarter"),
        "is_weekend", "is_holiday",
        F.col("name").alias("product_name"),
        F.col("brand_name").alias("product_brand"),
        F.col("main_category_name").alias("product_main_category"),
        F.col("sub_category_name").alias("product_sub_category"),
        F.col("gender_target").alias("product_gender_target"),
        F.col("list_price").alias("product_list_price"),
        "user_city", "user_gender", "user_registration_date", "user_lifetime_orders",
        "user_lifetime_value", "user_plus_status",
        F.col("transaction_coupon").isNotNull().alias("coupon_flag"),
        "return_status",
        F.col("product_quantity").alias("quantity"),
        F.col("product_revenue").alias("revenue"),
        cost.alias("cost"),
        (F.col("product_revenue") - cost).alias("gross_profit"),
        refund.alias("refund_amount"),
        (F.col("product_revenue") - refund).alias("net_revenue"),
    )


def lifetime_as_of(dim_users: DataFrame, stg_transactions: DataFrame) -> DataFrame:
    """`dim_users` with lifetime totals up to the start day of each version."""
    daily = (
        stg_transactions.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id", "date")
        .agg(
            F.countDistinct("transaction_id").alias("orders"),
            F.sum(F.col("transaction_total").cast(MONEY)).alias("value"),
        )
    )
    marks = dim_users.select("customer_id", F.col("valid_from").cast("date").alias("date"))
    upto = running_totals(marks.distinct(), daily, "customer_id", "date", ["orders", "value"])
    totals = upto.select(
        "customer_id",
        F.col("date").cast("timestamp").alias("valid_from"),
        F.coalesce(F.col("orders").cast("bigint"), F.lit(0)).alias("lifetime_orders"),
        F.coalesce(F.col("value").cast("double"), F.lit(0.0)).alias("lifetime_value"),
    )
    return (
        dim_users.drop("lifetime_orders", "lifetime_value")
        .join(totals, ["customer_id", "valid_from"], "left")
        .select(*dim_users.columns)
    )


def profile_changes(dim_users: DataFrame) -> DataFrame:
    """Customer versions after the first, with the attribute that changed.

    A comparison with a null on either side is not a change of that attribute.
    """
    window = Window.partitionBy("customer_id").orderBy("valid_from")
    before = {
        f"prev_{c}": F.lag(c).over(window)
        for c in ("city", "plus_status", "plus_tier", "lifetime_value")
    }
    versions = dim_users.where(F.col("customer_id").isNotNull()).withColumns(before)

    def differs(name: str) -> Column:
        return F.col(f"prev_{name}") != F.col(name)

    change = (
        F.when(differs("city"), "Location Change")
        .when(differs("plus_status"), "Plus Status Change")
        .when(differs("plus_tier"), "Plus Tier Change")
        .when(F.col("lifetime_value") > F.col("prev_lifetime_value"), "Value Increase")
        .otherwise("Other Change")
    )
    seen_before = F.coalesce(
        "prev_city", "prev_plus_tier", F.col("prev_plus_status").cast("string"),
        F.col("prev_lifetime_value").cast("string"),
    ).isNotNull()
    day = F.col("valid_from").cast("date")
    return versions.where(seen_before).select(
        "customer_id",
        F.lit("profile_change").alias("activity_type"),
        day.alias("activity_date"),
        F.col("city").alias("customer_city"),
        F.col("gender").alias("customer_gender"),
        "plus_status", "plus_tier", "opt_in_status", "lifetime_orders", "lifetime_value",
        "prev_city", "prev_plus_status", "prev_plus_tier", "prev_lifetime_value",
        F.lit(None).cast("bigint").alias("item_id"),
        F.lit(None).cast("bigint").alias("transaction_id"),
        F.lit(None).cast("bigint").alias("product_id"),
        F.lit(None).cast("double").alias("product_revenue"),
        F.lit(None).cast("bigint").alias("product_quantity"),
        customer_state(F.col("plus_status"), F.col("lifetime_orders")).alias(
            "customer_state_at_time"
        ),
        F.col("user_key").alias("customer_version_key"),
        change.alias("change_type"),
    )


#: What the activity mart shows of a product.
LISTED = {"brand_name": "product_brand", "main_category_name": "product_category", "list_price": "product_list_price"}
#: The same of further products of one id, where a catalog repeats it.
FURTHER = "__further"
#: Order of a customer's events of a day.
TIES = ["activity_type", "transaction_id", "item_id"]
#: Months whose groups of events are counted together.
STRETCH = 12


def listed(
    units: DataFrame,
    dim_products: DataFrame,
    dim_brand: DataFrame,
    dim_sub_category: DataFrame,
    dim_main_category: DataFrame,
) -> DataFrame:
    """Units bought by known customers with what the activity mart shows of their product.

    While units are narrow they move to their product at less cost than with their customer. A
    unit stays one row, so that it is one event: products that repeat its id are kept in a list.
    """
    catalog = _listed_catalog(dim_products, dim_brand, dim_sub_category, dim_main_category)
    found = F.sort_array(F.collect_list(F.struct(*LISTED.values())))
    catalog = (
        catalog.groupBy("product_id")
        .agg(found.alias("found"))
        .select(
            "product_id", F.col("found")[0].alias("first"),
            F.when(F.size("found") > 1, F.slice("found", 2, F.size("found"))).alias(FURTHER),
        )
        .select("product_id", "first.*", FURTHER)
    )
    known = units.where(F.col("customer_id").isNotNull())
    return left_lookup(known, catalog, "product_id", spread_by="item_id")


def _listed_catalog(*dimensions: DataFrame) -> DataFrame:
    return product_catalog(*dimensions).select(
        "product_id", *[F.col(c).alias(n) for c, n in LISTED.items()]
    )


def purchase_activity(
    units: DataFrame, dim_users: DataFrame, until: Column | None = None
) -> DataFrame:
    """Units bought by known customers with the customer version of that day, and the columns
    of `listed` where they have them. `until` as in `as_of_join`."""
    versions = dim_users.select(
        "customer_id", "valid_from", "valid_to",
        F.col("city").alias("customer_city"),
        F.col("gender").alias("customer_gender"),
        "plus_status", "plus_tier", "opt_in_status", "lifetime_orders", "lifetime_value",
        F.col("user_key").alias("customer_version_key"),
    )
    sold = units.select(
        "customer_id", date_from_key("date_key").alias("activity_date"),
        "item_id", "transaction_id", "product_id", "product_revenue", "product_quantity",
        *[c for c in units.columns if c in (*LISTED.values(), FURTHER)],
    )
    return as_of_join(sold, versions, "customer_id", "activity_date", "inner", until=until).select(
        "*",
        F.lit("transaction").alias("activity_type"),
        F.lit(None).cast("string").alias("prev_city"),
        F.lit(None).cast("boolean").alias("prev_plus_status"),
        F.lit(None).cast("string").alias("prev_plus_tier"),
        F.lit(None).cast("double").alias("prev_lifetime_value"),
        customer_state(F.col("plus_status"), F.col("lifetime_orders")).alias(
            "customer_state_at_time"
        ),
        F.lit("Purchase").alias("change_type"),
    )


def activity_events(
    units: DataFrame, dim_users: DataFrame, until: Column | None = None
) -> DataFrame:
    """Profile changes and purchases of all customers.

    Apply `lifetime_as_of` to `dim_users` first to see lifetime totals as they
    stood at each version instead of the all-time totals.
    """
    return profile_changes(dim_users).unionByName(
        purchase_activity(units, dim_users, until), allowMissingColumns=True
    )


def by_group(events: DataFrame) -> tuple[DataFrame, list[str]]:
    """Events with the marks of their group, and the columns that groups are stored by."""
    marks = group_marks(TIES)
    return events.withColumns(marks), ["customer_id", "activity_date", *marks]


def customer_activity(
    events: DataFrame,
    dim_date: DataFrame,
    dim_products: DataFrame,
    dim_brand: DataFrame,
    dim_sub_category: DataFrame,
    dim_main_category: DataFrame,
) -> DataFrame:
    """Profile changes and purchases (`activity_events`) of each customer in order.

    All events of a day carry noon as time, so ties are broken by kind,
    transaction and unit. The events are read twice and should be a stored or
    settled table. Those of `listed` units don't look their product up; those stored `by_group`
    aren't shuffled.
    """
    kept = [
        c for c in events.columns
        if c not in ("year_part", FURTHER, *LISTED.values(), *group_marks(TIES))
    ]
    calendar = dim_date.select(
        F.col("date").alias("activity_date"),
        F.col("year").alias("activity_year"),
        F.col("quarter").alias("activity_quarter"),
        F.col("month").alias("activity_month"),
        F.col("day_of_week").alias("activity_day_of_week"),
        F.col("is_weekend").alias("activity_is_weekend"),
    )
    rows = sequence_events(
        events.drop("year_part"), "customer_id", "activity_date", TIES, months=STRETCH
    )
    # what needs no shuffle comes after the one by product, so that it isn't carried through it
    if FURTHER in events.columns:
        one = F.array(F.struct(*LISTED.values()))
        every = F.when(F.col(FURTHER).isNull(), one).otherwise(F.concat(one, FURTHER))
        rows = rows.withColumn("__product", F.explode(every)).drop(*LISTED.values())
        rows = rows.select("*", "__product.*")
    else:
        catalog = _listed_catalog(dim_products, dim_brand, dim_sub_category, dim_main_category)
        rows = left_lookup(rows, catalog, "product_id", spread_by="sequence")
    rows = left_lookup(rows, calendar, "activity_date")
    day = F.col("activity_date")
    return rows.select(
        *kept,
        noon(day).alias("activity_timestamp"),
        F.col("sequence").alias("customer_activity_sequence"),
        F.col("prev_day").alias("prev_activity_date"),
        F.date_diff(day, F.col("prev_day")).alias("days_since_last_activity"),
        F.date_diff(day, F.col("first_day")).alias("customer_tenure_days"),
        *[c for c in calendar.columns if c != "activity_date"],
        *LISTED.values(),
    )


def daily_channel_performance(
    fct_advertising: DataFrame,
    fct_sessions: DataFrame,
    fct_transactions: DataFrame,
    dim_users: DataFrame,
    dim_date: DataFrame,
    dim_ad_platform: DataFrame,
    start: dt.date | None = None,
    end: dt.date | None = None,
) -> DataFrame:
    """Ad spend, sessions and sales per day, channel and platform.

    Sessions and sales are summed to day and platform before they meet, so an
    order of many units counts its revenue and its session once. `end` works
    only together with `start`.
    """

    def dated(df: DataFrame) -> DataFrame:
        if start is None:
            return df
        by_year = "year_part" in df.columns  # a stored table, whose other years are not read
        df = df.where(F.col("date_key") >= date_key(F.lit(start)))
        df = df.where(F.col("year_part") >= start.year) if by_year else df
        if end is None:
            return df
        df = df.where(F.col("date_key") <= date_key(F.lit(end)))
        return df.where(F.col("year_part") <= end.year) if by_year else df

    visits = dated(fct_sessions).where(F.col("platform_key").isNotNull())
    registered = current(dim_users).select(
        "customer_id", date_key("registration_date").alias("registered_on")
    )
    # One row per day, platform and customer; visits without login form one group,
    # pre-aggregated on the map side.
    per_customer = visits.groupBy("date_key", "platform_key", "customer_id").agg(
        F.count("*").alias("sessions"),
        F.count_if("bounce_flag").alias("bounces"),
        F.sum("page_views").alias("page_views"),
        F.sum("session_duration_seconds").alias("duration"),
        F.count("session_duration_seconds").alias("timed"),
    )
    known = left_lookup(
        per_customer, registered, "customer_id", spread_by=["date_key", "platform_key"]
    )
    visited = known.groupBy("date_key", "platform_key").agg(
        F.sum("sessions").alias("sessions"),
        F.count("customer_id").alias("total_users"),
        F.count_if(F.col("registered_on") == F.col("date_key")).alias("new_users"),
        F.sum("bounces").alias("bounces"),
        F.sum("page_views").alias("page_views"),
        ratio(F.sum("duration"), F.sum("timed")).alias("avg_session_duration"),
    )

    # Sales count where the order falls on the day of its session.
    orders = (
        dated(fct_transactions)
        .where(F.col("session_id").isNotNull())
        .groupBy("session_id", "date_key", "transaction_id")
        .agg(
            F.max("transaction_revenue").cast(MONEY).alias("revenue"),
            F.sum("product_quantity").alias("quantity"),
            F.sum((F.col("product_price") * F.col("product_quantity")).cast(MONEY)).alias("price"),
        )
    )
    sold = (
        orders.join(visits.select("session_id", "date_key", "platform_key"),
                    ["session_id", "date_key"])
        .groupBy("date_key", "platform_key")
        .agg(
            F.count("transaction_id").alias("transaction_count"),
            F.sum("revenue").cast("double").alias("total_revenue"),
            F.sum("quantity").alias("item_quantity"),
            F.sum("price").cast("double").alias("item_price_total"),
        )
    )

    day = F.col("date")
    calendar = dim_date.select("date_key", "date", "day_of_week", "month", "year")
    platforms = dim_ad_platform.select("platform_key", "channel_type", "platform_name")
    rows = left_lookup(dated(fct_advertising), calendar, "date_key")
    rows = left_lookup(rows, platforms, "platform_key")
    rows = left_lookup(rows, visited, ["date_key", "platform_key"])
    rows = left_lookup(rows, sold, ["date_key", "platform_key"])

    def count(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0).cast("bigint")).alias(name)

    return rows.select(
        "date",
        sunday_week(day).alias("week_number"),
        "day_of_week", "month", "year",
        F.col("channel_type").alias("channel"),
        F.col("platform_name").alias("platform"),
        "clicks", "impressions",
        F.col("cost").alias("ad_spend"),
        *[count(c) for c in ("sessions", "total_users", "new_users", "bounces", "page_views")],
        "avg_session_duration",
        count("transaction_count"),
        F.coalesce("total_revenue", F.lit(0.0)).alias("total_revenue"),
        count("item_quantity"),
        F.coalesce("item_price_total", F.lit(0.0)).alias("item_price_total"),
    )
