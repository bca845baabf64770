"""Named queries: every model and operator over the whole sample tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contract import values
from tillstar.functions import classify
from tillstar.functions.dates import (
    is_holiday, is_weekend, month_start, noon, seconds_between, sunday_week, time_of_day,
)
from tillstar.functions.keys import conformed_key, date_from_key, date_key
from tillstar.functions.numbers import digits_only_int, percent, ratio, safe_int
from tillstar.functions.text import capitalize_words, part, title_case
from tillstar.operators import listings, quality as q
from tillstar.operators.joins import left_lookup, orphans
from tillstar.operators.numbering import dense_key
from tillstar.operators.reshape import explode_units, union_all
from tillstar.operators.scd import as_of_join, current, scd2_apply, scd2_from_versions
from tillstar.operators.sequences import running_counts, sequence_events
from tillstar.operators.sessions import page_view_kinds_metrics, session_metrics
from tillstar.plans import checks, dims, exports, facts, marts, staging
from tillstar.plans.warehouse import Warehouse, competitor_star
from tillstar.sinks.writers import (
    as_view, commented, export_csv, export_parquet, load_csv, read_ordered, shared_folder,
    target_database, write_all, write_ordered, write_table,
)
from tillstar.sources.readers import (
    read_competitor_seed, read_landing, read_listing_json, read_raw_listings, read_source,
)
from tillstar.sources.schemas import SOURCES
from tillstar.sources.sample import (
    EventSources, OrderSources, listing_json, pick, raw_listings,
)

Query = Callable[[SparkSession, str], DataFrame]

CALENDAR = (dt.date(1995, 1, 1), dt.date(2030, 12, 31))
BUILD_DAY = dt.date(2024, 2, 1)
OWN_BRAND = "Brand#1"
CHANNELS = {"Search": ["google"], "Paid Social": ["meta", "tiktok"], "DSP": ["criteo", "rtbhouse"]}
SNAPSHOT_DAY = dt.date(1998, 1, 1)
SNAPSHOT_TAKEN = dt.date(2002, 1, 1)  # after the last order


def order_house(spark: SparkSession, folder: str) -> Warehouse:
    return Warehouse(spark, OrderSources(spark, folder), CALENDAR, F.lit(BUILD_DAY))


def event_house(spark: SparkSession, folder: str) -> Warehouse:
    return Warehouse(spark, EventSources(spark, folder), CALENDAR, F.lit(BUILD_DAY))


def _dates(df: DataFrame, *columns: str) -> DataFrame:
    """Show midnight timestamps as days."""
    return df.withColumns({c: F.col(c).cast("date") for c in columns})


# Tables several steps of a query read, computed once each.
CHANNEL = ("stg_sessions", "fct_sessions")
SETTLED = {
    "fct_sessions": ("stg_sessions",),
    "session_engagement": ("stg_sessions",),
    "rpt_daily_channel_performance": CHANNEL,
    "monthly_channel_performance": CHANNEL,
    "daily_spend_metrics": CHANNEL,
    "fct_transactions": ("dim_users",),
    "rpt_transactions": ("sales_units",),
    "rpt_customer_activity": ("dim_users", "listed_events"),
    "activity_mix": ("dim_users",),
    "rpt_customer_activity_as_of": ("dim_users", "dim_users_as_of", "listed_events_as_of"),
}


def _rows(name: str, house) -> Query:
    def run(spark, folder):
        return getattr(house(spark, folder).settle(*SETTLED.get(name, ())), name)

    return run


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# dimensions


def calendar_order_days(spark, folder):
    """Calendar days with the orders of each day."""
    house = order_house(spark, folder)
    daily = house.stg_transactions.groupBy("date").agg(F.count("*").alias("orders"))
    return left_lookup(house.dim_date, daily, "date")


def dim_users(spark, folder):
    return _dates(order_house(spark, folder).dim_users, "valid_from", "valid_to")


def dim_products(spark, folder):
    return _dates(order_house(spark, folder).dim_products, "valid_from", "valid_to")


def ad_channels_custom(spark, folder):
    house = event_house(spark, folder)
    return dims.ad_platform(house.stg_ad_platform_unpivoted, CHANNELS)


# marts


def channel_performance_window(spark, folder):
    house = event_house(spark, folder).settle(*CHANNEL)
    return house.channel_performance(dt.date(2024, 1, 8), dt.date(2024, 1, 21))


def channel_performance_from(spark, folder):
    house = event_house(spark, folder).settle(*CHANNEL)
    return house.channel_performance(start=dt.date(2024, 1, 15))


def weekly_signups_per_version(spark, folder):
    return exports.weekly_signups(order_house(spark, folder).stg_users, per_version=True)


# keys and functions


def conformed_keys(spark, folder):
    return _table(spark, folder, "part").select(
        "p_partkey",
        conformed_key("p_brand").alias("brand_key"),
        conformed_key("p_type", "p_name").alias("pair_key"),
        conformed_key("p_brand", F.when(F.col("p_size") > 25, F.col("p_type"))).alias("null_key"),
    )


def change_signatures(spark, folder):
    return dims.user_signatures(order_house(spark, folder).dim_users)


def date_functions(spark, folder):
    day = F.col("o_orderdate").cast("date")
    key = date_key(day)
    return _table(spark, folder, "orders").select(
        "o_orderkey",
        key.alias("day_key"),
        date_from_key(key).alias("day_from_key"),
        sunday_week(day).alias("week"),
        F.dayofweek(day).alias("weekday"),
        F.quarter(day).alias("quarter"),
        is_weekend(day).alias("weekend"),
        is_holiday(day).alias("holiday"),
        month_start(day).alias("month"),
        noon(day).alias("noon"),
    )


def event_times(spark, folder):
    """First and last event of each user, the seconds between and the time of day."""
    events = _table(spark, folder, "events")
    span = events.groupBy("user_id").agg(
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
    )
    return span.select(
        "user_id",
        seconds_between(F.col("first_ts"), F.col("last_ts")).alias("seconds"),
        time_of_day(F.col("first_ts")).alias("first_time"),
        F.date_diff(F.col("last_ts").cast("date"), F.col("first_ts").cast("date")).alias("days"),
    )


def safe_casts(spark, folder):
    """Casts that give null: ids with letters, blanks, and ratios by zero."""
    src = OrderSources(spark, folder).transactions
    return src.select(
        "transaction_id",
        digits_only_int(F.col("customer_id")).alias("digits_only"),
        safe_int(F.col("user_cookie_id")).alias("not_a_number"),
        ratio(
            F.col("transaction_total"), F.pmod(F.col("transaction_id").cast("bigint"), F.lit(3))
        ).alias("by_zero"),
        percent(F.col("transaction_revenue"), F.col("transaction_total")).alias("share"),
    )


def text_functions(spark, folder):
    hyphened = F.regexp_replace("p_name", " ", "-")
    return _table(spark, folder, "part").select(
        "p_partkey",
        title_case(F.concat_ws("'", hyphened, F.lower("p_brand"))).alias("title"),
        capitalize_words(F.concat_ws("  ", F.col("p_name"), F.lower("p_type"))).alias("words"),
        part(F.concat_ws(" , ", "p_type", "p_name"), ",", 1).alias("second"),
        part(F.col("p_name"), ",", 1).alias("absent"),
    )


def source_names(spark, folder):
    """Raw traffic sources with the name each is folded into."""
    raw = EventSources(spark, folder).sessions.groupBy("traffic_source").agg(
        F.count("*").alias("session_rows")
    )
    return raw.withColumn("source", classify.traffic_source(F.col("traffic_source")))


def agent_rules(spark, folder):
    """Ordered substring rules over the agents of page requests; some name several browsers
    or systems, some none, and some pages have no agent."""
    page = F.col("page_id")
    agent = F.when(
        page % 53 > 0,
        F.concat_ws(" ", pick(values.AGENT_BROWSERS, page),
                    pick(values.AGENT_SYSTEMS, F.floor(page / 7))),
    )
    return _table(spark, folder, "pages").select("page_id", agent.alias("agent")).select(
        "page_id",
        classify.browser(F.col("agent")).alias("browser"),
        classify.operating_system(F.col("agent")).alias("os"),
    )


# reshaping, sessions, versions


def unit_explosion(spark, folder):
    lines = OrderSources(spark, folder).transactionsanditems
    return explode_units(lines, "item_quantity", "unit_id", ["item_id"]).select(
        "unit_id", "transaction_id", "product_id", "unit_no", "item_price", "item_quantity"
    )


def session_measures(spark, folder):
    return session_metrics(event_house(spark, folder).stg_funnel_events)


def session_page_view_kinds(spark, folder):
    return page_view_kinds_metrics(event_house(spark, folder).stg_funnel_events)


def customer_totals(spark, folder):
    return staging.customer_totals(OrderSources(spark, folder).transactions)


def _tier_versions(house: Warehouse) -> DataFrame:
    return house.dim_users.select("customer_id", "valid_from", "valid_to", "plus_tier", "city")


def as_of_left_join(spark, folder):
    """Units with the customer's tier on the shipping day; guests and early units keep nulls."""
    house = order_house(spark, folder)
    headers = house.stg_transactions.select("transaction_id", "customer_id")
    units = left_lookup(
        house.stg_transactions_and_items.select("item_id", "transaction_id", "date"), headers,
        "transaction_id", spread_by="item_id",
    )
    return as_of_join(
        units, _tier_versions(house), "customer_id", "date", spread_by="item_id"
    )


def as_of_inner_join(spark, folder):
    house = order_house(spark, folder)
    headers = house.stg_transactions.select("transaction_id", "customer_id")
    units = house.stg_transactions_and_items.select("item_id", "transaction_id", "date").join(
        headers, "transaction_id"
    )
    return as_of_join(units, _tier_versions(house), "customer_id", "date", "inner")


def current_version_join(spark, folder):
    house = order_house(spark, folder)
    now = current(house.dim_users).select("customer_id", "city", "plus_status", "lifetime_orders")
    orders = house.stg_transactions.select("transaction_id", "customer_id")
    return left_lookup(orders, now, "customer_id", spread_by="transaction_id")


def scd2_snapshot(spark, folder):
    """Tier history up to a day, then a snapshot of later buyers applied to it."""
    orders = _table(spark, folder, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("day"),
        "o_orderkey", "o_orderpriority",
    )
    early = orders.where(F.col("day") < F.lit(SNAPSHOT_DAY))
    versions = early.groupBy("customer_id", F.col("day").alias("valid_from")).agg(
        F.max_by("o_orderpriority", "o_orderkey").alias("tier")
    )
    history = scd2_from_versions(versions, ["customer_id"], "valid_from")
    late = orders.where(F.col("day") >= F.lit(SNAPSHOT_DAY))
    snapshot = late.groupBy("customer_id").agg(
        F.max_by("o_orderpriority", F.struct("day", "o_orderkey")).alias("tier")
    )
    return scd2_apply(history, snapshot, ["customer_id"], ["tier"], F.lit(SNAPSHOT_TAKEN))


def lifetime_as_of(spark, folder):
    house = order_house(spark, folder)
    dated = marts.lifetime_as_of(house.dim_users, house.stg_transactions)
    return dated.select(
        "customer_id", F.col("valid_from").cast("date").alias("valid_from"), "lifetime_orders",
        "lifetime_value",
    )


def profile_changes(spark, folder):
    return marts.profile_changes(order_house(spark, folder).dim_users)


def event_sequence(spark, folder):
    """Order of each user's events by day and id."""
    events = _table(spark, folder, "events").select(
        "event_id", "user_id", F.col("ts").cast("date").alias("day")
    )
    return sequence_events(events, "user_id", "day", ["event_id"])


def profile_change_counts(spark, folder):
    """Changes of each customer's profile with the number of them so far."""
    changes = marts.profile_changes(order_house(spark, folder).dim_users).select(
        "customer_id", "activity_date", "change_type"
    )
    return running_counts(changes, "customer_id", "activity_date", "sequence_check")


def ordered_ad_numbers(spark, folder):
    """Ad numbers written by day and platform and read back in the order of the files."""
    numbers = event_house(spark, folder).stg_ad_platform_unpivoted.select(
        "date", "ad_platform", "clicks", "cost"
    )
    path = _fresh(spark)
    write_ordered(numbers, path, ["date", "ad_platform"])
    return read_ordered(spark, path, "position")


def dense_keys(spark, folder):
    """Products numbered by type and name, names in full."""
    named = _table(spark, folder, "part").select("p_type", "p_name").distinct()
    return dense_key(named, "name_no", ["p_type", "p_name"])


def purchase_times(spark, folder):
    return facts.purchase_times(order_house(spark, folder).stg_funnel_events)


def returns_per_item(spark, folder):
    return facts.returns_per_item(order_house(spark, folder).stg_product_returns)


def daily_sales_by_source(spark, folder):
    house = event_house(spark, folder).settle(*CHANNEL)
    sourced = exports.session_sources(house.fct_sessions, house.dim_source)
    return exports.daily_sales(house.fct_transactions, sourced)


def daily_sessions_by_source(spark, folder):
    house = event_house(spark, folder).settle(*CHANNEL)
    sourced = exports.session_sources(house.fct_sessions, house.dim_source)
    return sourced.groupBy("date_key", "source").agg(F.count("session_id").alias("session_num"))


# competitor listings


def _star(spark, folder) -> dict[str, DataFrame]:
    house = order_house(spark, folder)
    return competitor_star(
        raw_listings(spark, folder), house.stg_transactions_and_items,
        house.stg_product_attributes, OWN_BRAND, F.lit(BUILD_DAY),
    )


def _listing_table(name: str) -> Query:
    def run(spark, folder):
        df = _star(spark, folder)[name]
        if "transformation_timestamp" in df.columns:
            df = _dates(df, "transformation_timestamp")
        return df

    return run


def listing_flatten(spark, folder):
    return listings.flatten_listings(listing_json(spark, folder))


def _fresh(spark) -> str:
    return f"{shared_folder(spark)}/round-trip-{uuid.uuid4().hex}"


def sources_round_trip(spark, folder):
    """Rows and distinct keys of declared tables, written and read again."""
    keys = {
        "productattributes": "item_id", "product_costs": "item_id", "users": "customer_id",
        "product_listprices": "item_id", "transactions": "transaction_id",
        "transactionsanditems": "item_id", "product_returns": "item_id",
    }
    frames, path = OrderSources(spark, folder), _fresh(spark)
    write_all({n: frames[n] for n in keys}, path)
    return union_all([
        read_source(spark, path, n)
        .agg(F.count("*").alias("row_count"), F.countDistinct(key).alias("distinct_keys"))
        .select(F.lit(n).alias("table_name"), "row_count", "distinct_keys")
        for n, key in keys.items()
    ])


def listing_csv_round_trip(spark, folder):
    """Raw listings exported as CSV and read by the declared reader; titles hold quotes, commas
    and line breaks."""
    rough = raw_listings(spark, folder).withColumn(
        "title", F.concat(F.lit('a "b", '), "title", F.lit("\nc"))
    )
    path = export_csv(rough, _fresh(spark), "listings", BUILD_DAY)
    return read_raw_listings(spark, path).select("id", "search_term", "title", "price", "currency")


def listing_json_round_trip(spark, folder):
    """Search results as lines of JSON, read as text and flattened."""
    path = _fresh(spark)
    listing_json(spark, folder).write.text(path)
    return listings.flatten_listings(read_listing_json(spark, path))


def landing_round_trip(spark, folder):
    """Enriched listings exported by day and stored as the landing table, all read back."""
    landed = _star(spark, folder)["competitor_listings"]
    path = _fresh(spark)
    export_parquet(landed, path, "competitor_listings", BUILD_DAY)
    seed = export_csv(landed, path, "competitor_listings", BUILD_DAY)
    one = spark.read.schema(landed.schema).parquet(f"{path}/competitor_listings_{BUILD_DAY}.parquet")
    two = read_competitor_seed(spark, seed)
    write_all({"competitor_listings": landed}, path)
    read = {"parquet": one, "csv": two, "landing": read_landing(spark, path)}
    every = union_all([df.withColumn("kind", F.lit(kind)) for kind, df in read.items()])
    return every.groupBy("kind", "currency", "gender").agg(
        F.count("*").alias("rows"), F.countDistinct("id").alias("ids"),
        F.max("title").alias("last_title"),
    )


def stored_schema_drift(spark, folder):
    """Columns of stored copies against declared types: a changed type, a new column, a column
    declared without a type, and a table that isn't declared; with the rows of each copy."""
    frames, path = OrderSources(spark, folder), _fresh(spark)
    prices = frames["product_listprices"]
    copies = {
        "product_costs": frames["product_costs"].withColumn(
            "cost_of_item", F.col("cost_of_item").cast("float")
        ),
        "product_listprices": prices.withColumn("note", F.lit("new")),
        "unknown_prices": prices,
    }
    counts = write_all(copies, path)
    declared = {
        name: {f.name: f.dataType.simpleString() for f in SOURCES[name]}
        for name in ("product_costs", "product_listprices")
    }
    declared["product_listprices"]["item_id"] = None
    found = q.schema_drift(
        spark, {n: spark.read.parquet(f"{path}/{n}").schema for n in copies}, declared
    )
    sizes = F.create_map(*[F.lit(x) for pair in counts.items() for x in pair])
    return found.withColumn("row_count", sizes[F.col("table_name")].cast("bigint"))


def catalog_read_back(spark, folder):
    """Tables, a view and loaded listings as the catalog has them after two refreshes: layer,
    kind, comments of table and key, and rows."""
    house, base, path = order_house(spark, folder), f"base_{uuid.uuid4().hex[:8]}", _fresh(spark)
    parts = []

    def told(layer, name, full, key):
        about = {r.col_name: r for r in spark.sql(f"DESCRIBE EXTENDED {full}").collect()}
        listed = next(t for t in spark.catalog.listTables(full.rpartition(".")[0] or None) if t.name == full.rpartition(".")[2])
        comment = about["Comment"].data_type if "Comment" in about else None
        parts.append(spark.table(full).agg(F.count("*").alias("row_count")).select(
            F.lit(layer).alias("layer"), F.lit(name).alias("object_name"),
            F.lit(listed.tableType).alias("kind"), F.lit(comment).alias("comment"),
            F.lit(about[key].comment).alias("key_comment"), "row_count",
        ))

    for layer, name, key in (("core", "dim_brand", "brand_key"), ("marts", "dim_products", "product_id")):
        full = f"{target_database(layer, 'ci', base)}.{name}"
        df = commented(getattr(house, name), {key: f"Key of {name}"})
        for part in (df.where(F.col(key).isNull()), df):
            write_table(part, full, comment=f"Rows of {name}", path=f"{path}/{name}")
        told(layer, name, full, key)
    view = f"{base}_attributes"
    as_view(house.stg_product_attributes, view)
    told("staging", "stg_product_attributes", view, "item_id")
    listed = f"{target_database(None, 'ci', base)}.competitor_listings"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {base}")
    load_csv(spark, _star(spark, folder)["competitor_listings"], f"{path}/csv", listed)
    told("landing", "competitor_listings", listed, "id")
    return union_all(parts)


def listing_foreign_currency(spark, folder):
    flagged = listings.foreign_currency(raw_listings(spark, folder))
    return flagged.select("id", "currency", "is_foreign_currency")


def listing_attributes(spark, folder):
    """Brand, category and gender of every listing, wanted condition or not."""
    best = _star(spark, folder)["best_sellers"]
    parsed = listings.parse_listings(raw_listings(spark, folder), best)
    return parsed.select("id", "brand", "category", "gender")


# quality


def _sources(spark, folder, *event_tables: str) -> dict[str, DataFrame]:
    frames = dict(OrderSources(spark, folder))
    events = EventSources(spark, folder)
    for name in ("adplatform_data", "sessions", *event_tables):
        frames[name] = events[name]
    return frames


def check_source_rules(spark, folder):
    frames = _sources(spark, folder, "funnelevents")
    return q.check_report(frames, checks.source_rules(F.lit(BUILD_DAY)))


def check_listing_rules(spark, folder):
    landed = _star(spark, folder)["competitor_listings"]
    return q.check_report({"competitor_listings": landed}, checks.listing_rules())


class _Frames(dict):
    """Warehouse tables by name, built when asked for."""

    def __init__(self, house: Warehouse):
        super().__init__()
        self.house = house

    def __missing__(self, name: str) -> DataFrame:
        return getattr(self.house, name)


def check_core_rules(spark, folder):
    house = event_house(spark, folder).settle(
        "stg_sessions", "stg_users", "geo_locations", "dim_users", "dim_source", "dim_medium",
        "dim_geo", "dim_devices", "dim_ad_platform", "fct_sessions", "fct_transactions",
        "fct_advertising",
    )
    return q.check_report(_Frames(house), checks.core_rules())


def check_mart_rules(spark, folder):
    house = event_house(spark, folder).settle(
        "stg_sessions", "dim_users", "fct_sessions", "fct_transactions", "rpt_transactions",
        "activity_events", "rpt_customer_activity",
    )
    return q.check_report(_Frames(house), checks.mart_rules())


def check_critical_rules(spark, folder):
    house = order_house(spark, folder).settle("sales_units", "rpt_transactions")
    return q.check_report(_Frames(house), checks.mart_rules(), ["critical"])


def check_competitor_rules(spark, folder):
    return q.check_report(_star(spark, folder), checks.competitor_rules())


def check_null_rows(spark, folder):
    """Orders without a usable customer."""
    frames = {"orders": order_house(spark, folder).stg_transactions}
    [rule] = q.not_null("orders", "customer_id")
    return q.violations(frames, rule).select("transaction_id", "date", "transaction_total")


def check_duplicate_lines(spark, folder):
    """Order and line number pairs found more than once."""
    frames = {"lineitem": _table(spark, folder, "lineitem")}
    return q.violations(
        frames, q.unique_combination("lineitem", "l_orderkey", "l_linenumber")
    )


def check_duplicate_days(spark, folder):
    """Customers ordering more than once on a day."""
    frames = {"orders": _table(spark, folder, "orders")}
    return q.violations(frames, q.unique_combination("orders", "o_custkey", "o_orderdate"))


def check_orphan_sessions(spark, folder):
    """Order sessions that no web session knows."""
    child = order_house(spark, folder).stg_transactions
    parent = event_house(spark, folder).stg_sessions
    return orphans(child, "session_id", parent, "session_id")


def check_accepted_values(spark, folder):
    frames = {"sessions": EventSources(spark, folder).sessions}
    rule = q.accepted_values("sessions", "traffic_medium", ["organic", "paid", "email"])
    return q.violations(frames, rule).groupBy("traffic_medium").agg(
        F.count("*").alias("bad_rows")
    )


def check_numeric_range(spark, folder):
    frames = {"part": _table(spark, folder, "part")}
    rule = q.numeric_range("part", "p_size", 5, 45, where="p_type <> 'PROMO'")
    return q.violations(frames, rule).select("p_partkey", "p_size")


def check_text_pattern(spark, folder):
    frames = {"part": _table(spark, folder, "part")}
    rule = q.text_pattern("part", "p_name", "^(red|blue|old) [a-z]+$")
    return q.violations(frames, rule).select("p_partkey", "p_name")


def check_injection(spark, folder):
    """Documents whose text holds anything like an injected command."""
    frames = {"documents": _table(spark, folder, "documents")}
    rule = q.injection_scan("documents", "text")
    return q.violations(frames, rule).select("doc_id")


def source_freshness(spark, folder):
    now = F.lit(dt.datetime(2024, 2, 1, 12)).cast("timestamp")
    report = q.freshness(_table(spark, folder, "events"), "ts", now)
    return report.select(F.round("age_hours", 3).alias("age_hours"), "status")


def null_comparison(spark, folder):
    src = OrderSources(spark, folder).transactions
    staged = staging.transactions(src)
    return q.compare_nulls(src, staged, ["customer_id", "session_id", "transaction_coupon"])


def table_profile(spark, folder):
    staged = order_house(spark, folder).stg_transactions
    return q.profile(staged, today=F.lit(dt.date(2001, 1, 1)))


def staged_validation(spark, folder):
    """What is looked at before a release, over all orders."""
    src = OrderSources(spark, folder).transactions
    return checks.validation_report(src, staging.transactions(src))


def product_updates(spark, folder):
    """Products with the latest update of their attributes, prices and costs, of which the
    sources carry different ones or none."""
    house = order_house(spark, folder)

    def stamped(df, key, days):
        number = F.col(key).cast("bigint")
        moment = F.date_add(F.lit(BUILD_DAY), F.pmod(number, F.lit(days)).cast("int"))
        return df.withColumn("updated_at", F.when(number % 11 > 0, moment).cast("timestamp"))

    rows = dims.products(
        stamped(house.stg_product_attributes, "item_id", 5),
        stamped(house.stg_product_list_prices, "product_id", 7).where("product_id % 2 = 0"),
        stamped(house.stg_product_costs, "product_id", 13).withColumn(
            "updated_at", F.when(F.col("product_id") % 3 > 0, F.col("updated_at"))
        ),
    )
    return rows.select("product_id", F.col("updated_at").cast("date").alias("updated_on"))


def relationship_counts(spark, folder):
    parent = _table(spark, folder, "orders").select(F.col("o_custkey").alias("customer"))
    child = _table(spark, folder, "customer").select(F.col("c_custkey").alias("customer"))
    return q.relationship_counts(parent, child, "customer")


def row_counts(spark, folder):
    house = order_house(spark, folder).settle("dim_users", "fct_transactions")
    names = (
        "stg_transactions", "fct_transactions", "dim_users", "dim_products", "dim_date",
        "rpt_transactions",
    )
    return q.row_counts({n: getattr(house, n) for n in names})


def missing_activity_types(spark, folder):
    """The web purchases have no profile changes, so one row reports it."""
    return q.missing_activity_types(event_house(spark, folder).activity_events)


def _loose_versions(spark, folder) -> DataFrame:
    """Order rows read as versions: filled orders end after 30 days, others stay open."""
    filled = F.col("o_orderstatus") == "F"
    day = F.col("o_orderdate").cast("date")
    per_day = _table(spark, folder, "orders").groupBy("o_custkey", day.alias("valid_from"))
    merged = per_day.agg(
        F.max(filled).alias("filled"), F.max(F.col("o_orderpriority") == "1-URGENT").alias("hot")
    )
    return merged.select(
        F.col("o_custkey").alias("customer_id"),
        "valid_from",
        F.when(F.col("filled"), F.date_add("valid_from", 30)).alias("valid_to"),
        (~F.col("filled") | F.col("hot")).alias("is_current"),
    )


def check_scd_integrity(spark, folder):
    return q.scd_integrity(_loose_versions(spark, folder), "customer_id", "loose_versions")


def check_scd_timeline(spark, folder):
    return q.scd_timeline(_loose_versions(spark, folder), "customer_id")


def check_users_timeline(spark, folder):
    """No rows: the customer dimension is sound."""
    return q.scd_timeline(order_house(spark, folder).dim_users, "customer_id")


def check_users_timeline_gaps(spark, folder):
    """The customer dimension of which some customers lack past versions of odd months, and
    others the current one."""
    customer = F.col("customer_id")
    past = (customer % 5 == 0) & ~F.col("is_current") & (F.month("valid_from") % 2 == 1)
    now = (customer % 7 == 0) & F.col("is_current")
    dim = order_house(spark, folder).dim_users
    return q.scd_timeline(dim.where(~(past | now)), "customer_id")


def check_activity_timeline(spark, folder):
    """Activity moved back a week and without the first purchase of every third customer,
    against the customer versions."""
    house = order_house(spark, folder).settle("dim_users", "listed_events")
    first = (F.col("customer_activity_sequence") == 1) & (F.col("customer_id") % 3 == 0)
    kept = house.rpt_customer_activity.where(~first)
    moved = kept.withColumn("activity_date", F.date_sub("activity_date", 7))
    return q.activity_timeline(moved, house.dim_users)


def source_gate(spark, folder):
    return checks.source_gate(_sources(spark, folder))


def source_invariants(spark, folder):
    return checks.source_invariants(_sources(spark, folder))


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for name in (
        "stg_product_attributes", "stg_product_costs", "stg_product_list_prices",
        "stg_product_returns", "stg_transactions", "stg_transactions_and_items", "stg_users",
        "dim_brand", "dim_main_category", "dim_sub_category", "fct_transactions",
        "rpt_transactions", "rpt_customer_activity", "rpt_customer_activity_as_of",
        "weekly_brand_sales", "weekly_signups", "category_profitability",
        "average_order_value", "activity_mix", "top_customers",
    ):
        found[name] = _rows(name, order_house)
    for name in (
        "stg_ad_platform", "stg_ad_platform_unpivoted", "stg_funnel_events", "stg_sessions",
        "geo_locations", "dim_country", "dim_region", "dim_geo", "dim_source", "dim_medium",
        "dim_devices", "dim_ad_platform", "fct_advertising", "fct_sessions",
        "rpt_daily_channel_performance", "daily_spend_metrics", "weekly_ad_spend",
        "monthly_channel_performance", "session_engagement",
    ):
        found[name] = _rows(name, event_house)
    found["fct_transactions_web"] = _rows("fct_transactions", event_house)
    found["rpt_transactions_web"] = _rows("rpt_transactions", event_house)
    for name in (
        "best_sellers", "search_terms", "competitor_listings", "competitor_dim_brand",
        "competitor_dim_category", "competitor_fct_items",
    ):
        found[name] = _listing_table(name)
    for query in (
        calendar_order_days, dim_users, dim_products, ad_channels_custom,
        channel_performance_window, channel_performance_from, weekly_signups_per_version,
        conformed_keys, change_signatures, date_functions, event_times, safe_casts,
        text_functions, source_names, agent_rules, unit_explosion, session_measures,
        session_page_view_kinds, customer_totals, as_of_left_join, as_of_inner_join,
        current_version_join, scd2_snapshot, lifetime_as_of, profile_changes, event_sequence,
        profile_change_counts, ordered_ad_numbers, dense_keys, purchase_times, returns_per_item, daily_sales_by_source,
        daily_sessions_by_source, sources_round_trip, listing_csv_round_trip,
        listing_json_round_trip, landing_round_trip, stored_schema_drift, catalog_read_back, listing_flatten, listing_foreign_currency,
        listing_attributes, check_source_rules, check_listing_rules, check_core_rules,
        check_mart_rules, check_critical_rules, check_competitor_rules, check_null_rows,
        check_duplicate_lines, check_duplicate_days, check_orphan_sessions,
        check_accepted_values, check_numeric_range, check_text_pattern, check_injection,
        source_freshness, null_comparison, table_profile, staged_validation, product_updates,
        relationship_counts, row_counts,
        missing_activity_types, check_scd_integrity, check_scd_timeline, check_users_timeline,
        check_users_timeline_gaps,
        check_activity_timeline, source_gate, source_invariants,
    ):
        found[query.__name__] = query
    return found
