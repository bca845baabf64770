"""Declared checks of the warehouse: sources, dimensions and facts, marts, competitor star."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.functions.numbers import MONEY
from tillstar.operators import quality as q
from tillstar.operators.joins import left_lookup, orphans
from tillstar.operators.reshape import union_all
from tillstar.sources.schemas import AD_PLATFORMS, RETAIL_TABLES

# Accepted values and bounds.
FIRST_DAY = "2020-01-01"
DEVICES = ["desktop", "mobile", "tablet", "unknown"]
EVENTS = [
    "page_view", "add_to_cart", "purchase", "begin_checkout", "view_item", "remove_from_cart",
]
RETURN_STATUSES = ["Refund", "Exchange"]
USER_GENDERS = ["M", "F", "Non-binary", "Unknown"]
PRODUCT_GENDERS = ["men", "women", "unisex", "kids"]
TRAFFIC_MEDIUMS = [
    "organic", "paid", "email", "social", "direct", "referral", "cpc", "display", "(none)", "crm",
    "affiliate", "influencer", "cpm", "organic_social", "paid_social", "comparison", "cpv",
]
CURRENCIES = ["USD", "EUR", "GBP", "CAD"]
LISTING_CONDITIONS = ["New with tags", "New with box", "New without tags"]
LISTING_GENDERS = ["mens", "womens", "unisex", "kids"]
ACTIVITY_TYPES = ["profile_change", "transaction", "session"]
CUSTOMER_STATES = ["New Customer", "Repeat Customer", "Loyal Customer", "Premium Customer"]
WARN = {"severity": q.WARN}
CRITICAL = {"tags": ("critical",)}


def source_rules(today: Column | None = None) -> list[q.Rule]:
    """Checks on the ten retail sources."""
    today = F.current_date() if today is None else today

    def dated(table: str, column: str) -> q.RowRule:
        return q.accepted_range(table, column, F.lit(FIRST_DAY).cast("date"), today)

    ad, events, users = "adplatform_data", "funnelevents", "users"
    returns, headers, units = "product_returns", "transactions", "transactionsanditems"
    ranged = [f"{p}_{m}" for p in ("criteo", "google") for m in ("clicks", "cost", "impressions")]
    return [
        q.unique_combination(ad, "date"),
        *q.not_null(ad, "date"),
        dated(ad, "date"),
        *[q.accepted_range(ad, c, 0) for c in ranged],
        *q.not_null(events, "date", "event_name", "event_time", "session_id"),
        q.accepted_values(events, "device_category", DEVICES, **WARN),
        q.accepted_values(events, "event_name", EVENTS, **WARN),
        q.unique_combination("product_costs", "item_id"),
        *q.not_null("product_costs", "cost_of_item", "item_id"),
        q.accepted_range("product_costs", "cost_of_item", 0),
        q.unique("product_costs", "item_id"),
        q.unique_combination("product_listprices", "item_id"),
        *q.not_null("product_listprices", "item_id", "item_list_price"),
        q.unique("product_listprices", "item_id"),
        q.accepted_range("product_listprices", "item_list_price", 0),
        q.unique_combination(returns, "transaction_id", "item_id", **WARN),
        *q.not_null(returns, "return_date", "transaction_id", "item_id", "product_id"),
        dated(returns, "return_date"),
        q.accepted_range(returns, "return_quantity", 0),
        q.accepted_values(returns, "return_status", RETURN_STATUSES, **WARN),
        *q.not_null("productattributes", "item_id"),
        q.unique("productattributes", "item_id"),
        *q.not_null("sessions", "date", "session_id"),
        dated("sessions", "date"),
        q.accepted_values("sessions", "device_category", DEVICES, **WARN),
        q.accepted_values("sessions", "traffic_medium", TRAFFIC_MEDIUMS, **WARN),
        q.unique_combination(headers, "transaction_id"),
        *q.not_null(headers, "transaction_id", "date", "session_id"),
        q.unique(headers, "transaction_id"),
        dated(headers, "date"),
        *[
            q.accepted_range(headers, f"transaction_{c}", 0)
            for c in ("revenue", "shipping", "total")
        ],
        *q.not_null(units, "item_id", "transaction_id", "product_id", "date"),
        q.unique(units, "item_id"),
        dated(units, "date"),
        q.accepted_range(units, "item_price", 0),
        q.accepted_range(units, "item_quantity", 1),
        q.unique_combination(users, "customer_id", "valid_from"),
        *q.not_null(users, "customer_id", "valid_from"),
        q.injection_scan(users, "customer_id", **WARN),
        q.accepted_values(users, "user_gender", USER_GENDERS, **WARN),
        q.injection_scan(users, "user_gender", **WARN),
    ]


def listing_rules() -> list[q.Rule]:
    """Checks on the competitor landing table."""
    table = "competitor_listings"
    return [
        q.unique_combination(table, "id"),
        q.unique(table, "id"),
        *q.not_null(table, "id", "title", "url", "transformation_timestamp"),
        q.accepted_range(table, "price", 0),
        q.accepted_values(table, "currency", CURRENCIES, **WARN),
        q.accepted_values(table, "condition", LISTING_CONDITIONS, **WARN),
        q.accepted_values(table, "gender", LISTING_GENDERS, **WARN),
    ]


def _keyed(table: str, column: str, **kw) -> list[q.Rule]:
    return [q.unique(table, column, **kw), *q.not_null(table, column, **kw)]


def core_rules() -> list[q.Rule]:
    """Checks on dimensions and facts."""
    return [
        *_keyed("dim_date", "date_key"),
        *q.not_null("dim_date", "date"),
        *_keyed("dim_users", "user_key"),
        *q.not_null("dim_users", "customer_id", "valid_from", "is_current"),
        *_keyed("dim_products", "product_key"),
        *q.not_null("dim_products", "product_id", "valid_from", "is_current"),
        q.relationship("dim_products", "brand_key", "dim_brand", "brand_key"),
        q.relationship("dim_products", "sub_category_key", "dim_sub_category", "sub_category_key"),
        *_keyed("dim_brand", "brand_key"),
        *_keyed("dim_main_category", "main_category_key"),
        *_keyed("dim_sub_category", "sub_category_key"),
        q.relationship(
            "dim_sub_category", "main_category_key", "dim_main_category", "main_category_key"
        ),
        *_keyed("dim_source", "source_key"),
        *_keyed("dim_medium", "medium_key"),
        *_keyed("dim_geo", "geo_key"),
        q.relationship(
            "dim_geo", "region_key", "dim_region", "region_key", where="region_key is not null"
        ),
        *_keyed("dim_region", "region_key"),
        q.relationship("dim_region", "country_key", "dim_country", "country_key"),
        *_keyed("dim_country", "country_key"),
        *_keyed("dim_devices", "device_key"),
        *_keyed("dim_ad_platform", "platform_key"),
        q.unique("fct_sessions", "session_id", **WARN),
        *q.not_null("fct_sessions", "session_id", "date_key"),
        q.relationship("fct_sessions", "date_key", "dim_date", "date_key"),
        q.relationship(
            "fct_sessions", "customer_id", "dim_users", "customer_id",
            where="customer_id is not null", **WARN,
        ),
        q.relationship("fct_sessions", "source_key", "dim_source", "source_key", **WARN),
        q.relationship("fct_sessions", "platform_key", "dim_ad_platform", "platform_key"),
        q.relationship("fct_sessions", "medium_key", "dim_medium", "medium_key", **WARN),
        q.relationship("fct_sessions", "geo_key", "dim_geo", "geo_key"),
        q.relationship("fct_sessions", "device_key", "dim_devices", "device_key"),
        *_keyed("fct_transactions", "item_id"),
        *q.not_null("fct_transactions", "date_key"),
        q.relationship("fct_transactions", "date_key", "dim_date", "date_key"),
        q.relationship(
            "fct_transactions", "customer_id", "dim_users", "customer_id",
            where="customer_id is not null", **WARN,
        ),
        q.relationship("fct_transactions", "session_id", "fct_sessions", "session_id", **WARN),
        q.relationship("fct_transactions", "product_id", "dim_products", "product_id"),
        *_keyed("fct_advertising", "ad_key"),
        *q.not_null("fct_advertising", "date_key"),
        q.relationship("fct_advertising", "date_key", "dim_date", "date_key"),
        q.relationship("fct_advertising", "platform_key", "dim_ad_platform", "platform_key"),
    ]


def mart_rules(audited: bool = False) -> list[q.Rule]:
    """Checks on the marts; the sales mart's key checks are critical.

    With `audited` the activity mart must also say when it was built.
    """
    sales, activity = "rpt_transactions", "rpt_customer_activity"
    return [
        *_keyed(sales, "item_id", **CRITICAL),
        *q.not_null(sales, "date_key", "product_id", **CRITICAL),
        q.relationship(sales, "date_key", "dim_date", "date_key", **CRITICAL),
        q.relationship(
            sales, "customer_id", "dim_users", "customer_id", where="customer_id is not null",
            **WARN,
        ),
        q.relationship(sales, "product_id", "dim_products", "product_id", **CRITICAL),
        *q.not_null(
            sales, "coupon_flag", "quantity", "revenue", "refund_amount", "net_revenue"
        ),
        *q.not_null(
            activity, "customer_id", "activity_type", "activity_date", "activity_timestamp",
            "customer_state_at_time", "customer_version_key", "change_type",
            "customer_activity_sequence", "customer_tenure_days",
            *["mart_updated_at"] * audited,
        ),
        q.accepted_values(activity, "activity_type", ACTIVITY_TYPES),
        q.accepted_values(activity, "customer_state_at_time", CUSTOMER_STATES),
        *q.not_null("rpt_daily_channel_performance", "date"),
    ]


def competitor_rules() -> list[q.Rule]:
    """Checks on the competitor star."""
    return [
        *_keyed("competitor_dim_brand", "brand_id"),
        *_keyed("competitor_dim_brand", "brand"),
        *_keyed("competitor_dim_category", "category_id"),
        *_keyed("competitor_dim_category", "category"),
        *_keyed("competitor_fct_items", "id"),
        *q.not_null("competitor_fct_items", "brand_id", "category_id"),
    ]


# Child column -> parent column that must hold before a build.
SOURCE_FOREIGN_KEYS = [
    ("transactions", "session_id", "sessions", "session_id"),
    ("transactionsanditems", "transaction_id", "transactions", "transaction_id"),
    ("transactionsanditems", "product_id", "productattributes", "item_id"),
    ("funnelevents", "session_id", "sessions", "session_id"),
    ("product_returns", "transaction_id", "transactions", "transaction_id"),
    ("product_returns", "item_id", "transactionsanditems", "item_id"),
]
SOURCE_ACCEPTED = [
    ("users", "user_gender", USER_GENDERS),
    ("sessions", "device_category", DEVICES),
    ("product_returns", "return_status", RETURN_STATUSES),
]


def source_gate(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts, orphans and unexpected values of the sources, as one report."""

    def line(kind: str, subject: str, df: DataFrame, amount: Column) -> DataFrame:
        total = amount.cast("bigint").alias("amount")
        return df.agg(total).select(F.lit(kind).alias("kind"), F.lit(subject).alias("subject"), "amount")

    parts = [line("row_count", t, frames[t], F.count("*")) for t in RETAIL_TABLES if t in frames]
    for child, column, parent, parent_column in SOURCE_FOREIGN_KEYS:
        lost = orphans(frames[child], column, frames[parent], parent_column)
        total = F.coalesce(F.sum("child_rows"), F.lit(0))
        parts.append(line("orphans", f"{child}.{column} -> {parent}.{parent_column}", lost, total))
    for table, column, values in SOURCE_ACCEPTED:
        bad = q.accepted_values(table, column, values).bad
        parts.append(line("unexpected_values", f"{table}.{column}", frames[table], F.count_if(bad)))
    return union_all(parts)


def source_invariants(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Business invariants of the sources with the number of violations of each."""

    def count(name: str, df: DataFrame, bad: Column) -> DataFrame:
        broken = F.count_if(bad).cast("bigint").alias("violations")
        return df.agg(broken).select(F.lit(name).alias("invariant"), "violations")

    headers, units = frames["transactions"], frames["transactionsanditems"]
    sums = units.groupBy("transaction_id").agg(
        F.sum((F.col("item_price") * F.col("item_quantity")).cast(MONEY)).alias("unit_sum")
    )
    summed = left_lookup(headers, sums, "transaction_id", spread_by="session_id")
    off_sum = F.abs(F.col("transaction_revenue").cast(MONEY) - F.coalesce("unit_sum", F.lit(0)))
    parts = [
        count("order revenue is the sum of its units", summed, off_sum >= F.lit(0.01).cast(MONEY)),
        count(
            "order total is revenue plus shipping", headers,
            F.abs(
                F.col("transaction_total")
                - (F.col("transaction_revenue") + F.col("transaction_shipping"))
            ) >= 0.01,
        ),
        count("a unit row has quantity one", units, F.col("item_quantity") != 1),
    ]

    if "adplatform_data" in frames:
        bad = F.lit(False)
        for p in AD_PLATFORMS:
            bad = bad | (F.col(f"{p}_clicks") > F.col(f"{p}_impressions"))
        parts.append(count("clicks do not exceed impressions", frames["adplatform_data"], bad))

    prices = frames["product_listprices"].join(frames["product_costs"], "item_id")
    parts.append(
        count(
            "list price covers cost", prices, F.col("item_list_price") < F.col("cost_of_item")
        )
    )
    parts.append(
        count(
            "product gender is known", frames["productattributes"],
            F.col("item_gender").isNull() | ~F.col("item_gender").isin(PRODUCT_GENDERS),
        )
    )
    is_purchase = F.col("event_name") == "purchase"
    parts.append(
        count(
            "purchase events and only they name a transaction", frames["funnelevents"],
            is_purchase != F.col("transaction_id").isNotNull(),
        )
    )

    users = frames["users"]
    registered = users.groupBy("customer_id").agg(F.min("registration_date").alias("joined"))
    if "sessions" in frames:
        visits = frames["sessions"].where(F.col("customer_id").isNotNull())
        parts.append(
            count(
                "logged-in activity is on or after registration",
                visits.join(registered, "customer_id"), F.col("date") < F.col("joined"),
            )
        )
    return union_all(parts + version_invariants(users, count))


def version_invariants(users: DataFrame, count) -> list[DataFrame]:
    """Versions are ordered, each changes something, the oldest starts at registration,
    and a tier is set exactly for members."""
    tracked = ["city", "user_gender", "opt_in_status", "plus_status", "plus_tier"]
    window = Window.partitionBy("customer_id").orderBy("valid_from")
    state = F.struct(*tracked)
    ordered = users.select(
        "*",
        F.lag("valid_from").over(window).alias("prev_from"),
        F.lag(state).over(window).alias("prev_state"),
    )
    later = F.col("prev_from").isNotNull()
    return [
        count("versions have different start days", ordered, F.col("prev_from") == F.col("valid_from")),
        count("a version changes a tracked attribute", ordered, later & state.eqNullSafe(F.col("prev_state"))),
        count(
            "the oldest version starts at registration", ordered,
            ~later & ~F.col("valid_from").eqNullSafe(F.col("registration_date")),
        ),
        count(
            "a tier is set exactly for members", users,
            F.col("plus_status") != F.col("plus_tier").isNotNull(),
        ),
    ]


# Columns the staged transactions must have.
STAGED_TRANSACTION_COLUMNS = [
    "date", "user_cookie_id", "customer_id", "session_id", "transaction_id",
    "transaction_coupon", "transaction_revenue", "transaction_shipping", "transaction_total",
]


def validation_report(
    transactions_src: DataFrame, stg_transactions: DataFrame
) -> DataFrame:
    """The findings of `validate_before_release` as rows of step, subject and number.

    Numbers are the counts of the profile and of the relationship, what staging adds to the
    nulls of a column, and 1 for an expected column that is there, else 0.
    """
    steps = validate_before_release(transactions_src, stg_transactions)
    counts = [
        "total_records", "unique_users", "unique_keys", "null_users", "null_keys", "null_amounts",
        "non_positive_amounts",
    ]

    def listed(step: str, columns: list[str]) -> DataFrame:
        long = steps[step].select(*[F.col(c).cast("bigint").alias(c) for c in columns]).unpivot(
            [], columns, "subject", "number"
        )
        return long.select(F.lit(step).alias("step"), "subject", "number")

    def pairs(step: str, number: Column) -> DataFrame:
        return steps[step].select(
            F.lit(step).alias("step"), F.col("column_name").alias("subject"),
            number.cast("bigint").alias("number"),
        )

    return union_all([
        listed("profile", counts),
        pairs("null_comparison", F.col("null_difference")),
        listed("relationship", steps["relationship"].columns),
        pairs("columns", F.col("status") == "ok"),
    ])


def validate_before_release(
    transactions_src: DataFrame, stg_transactions: DataFrame
) -> dict[str, DataFrame]:
    """Profile, null comparison, relationship counts and columns of staged transactions, in order."""
    staged_key = stg_transactions.withColumn(
        "transaction_id", F.col("transaction_id").cast("string")
    )
    return {
        "profile": q.profile(stg_transactions),
        "null_comparison": q.compare_nulls(transactions_src, stg_transactions, ["customer_id"]),
        "relationship": q.relationship_counts(transactions_src, staged_key, "transaction_id"),
        "columns": q.expected_columns(stg_transactions, STAGED_TRANSACTION_COLUMNS),
    }

