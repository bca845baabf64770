"""Source tables derived from the sample order and event tables.

The sample data has no retail sources, so each function maps whole sample
tables onto one source shape. `OrderSources` covers customers, orders and
order lines; `EventSources` covers web events. The two do not overlap in time.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.functions.keys import conformed_key
from tillstar.functions.numbers import money_sum
from tillstar.sources.schemas import AD_PLATFORMS, RETAIL_TABLES

GENDERS = ["M", "F", "Non-binary", "Unknown"]
PRODUCT_GENDERS = ["men", "women", "unisex", "kids"]
DEVICES = ["desktop", "mobile", "tablet", "unknown"]
RAW_SOURCES = [
    "google", "YouTube.com", "facebook", " l.instagram.com ", "TikTok", "awin", "dv360", "bing",
]
MEDIUMS = [
    "organic", "paid", "email", "social", "direct", "referral", "cpc", "display", "(none)", "crm",
]
LISTING_GENDERS = ["mens", "womens", "unisex"]
CONDITIONS = ["New with tags", "New with box", "New without tags", "Pre-owned", "Open box"]
CURRENCIES = ["GBP", "GBP", "GBP", "USD"]
EVENT_NAMES = {
    "view": "page_view",
    "click": "add_to_cart",
    "signup": "begin_checkout",
    "error": "remove_from_cart",
    "purchase": "purchase",
}


def pick(values: list[str], index: Column) -> Column:
    """`values[index % len(values)]` as an expression."""
    array = F.array(*[F.lit(v) for v in values])
    return F.element_at(array, (F.pmod(index, F.lit(len(values))) + 1).cast("int"))


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


class _Sample(Mapping):
    """Source tables by name, each read and mapped when first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._read: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = read_table(self.spark, self.folder, name)
        return self._read[name]

    def _names(self) -> list[str]:
        return [n for n in RETAIL_TABLES if hasattr(type(self), n)]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names():
            raise KeyError(name)
        return getattr(self, name)

    def __iter__(self):
        return iter(self._names())

    def __len__(self) -> int:
        return len(self._names())

    @cached_property
    def productattributes(self) -> DataFrame:
        first_word = F.substring_index("p_name", " ", 1)
        return self.table("part").select(
            F.col("p_partkey").cast("string").alias("item_id"),
            F.col("p_brand").alias("item_brand"),
            pick(PRODUCT_GENDERS, F.col("p_size")).alias("item_gender"),
            F.col("p_type").alias("item_main_category"),
            F.col("p_name").alias("item_name"),
            F.concat_ws(" ", "p_type", first_word).alias("item_sub_category"),
        )

    @cached_property
    def product_costs(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").cast("string").alias("item_id"),
            F.round(F.col("p_retailprice") * 0.6, 2).alias("cost_of_item"),
        )

    @cached_property
    def product_listprices(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").cast("string").alias("item_id"),
            F.col("p_retailprice").alias("item_list_price"),
        )


class OrderSources(_Sample):
    """Customers, orders and order lines. One order line stands for one unit row."""

    @cached_property
    def users(self) -> DataFrame:
        """One version per customer and order day; the day's last order sets the tier."""
        orders = self.table("orders").select(
            "o_custkey", "o_orderkey", "o_orderpriority",
            F.col("o_orderdate").cast("date").alias("day"),
        )
        versions = orders.groupBy("o_custkey", "day").agg(
            F.max_by("o_orderpriority", "o_orderkey").alias("tier")
        )
        life = orders.groupBy("o_custkey").agg(
            F.min("day").alias("first_day"), F.max("day").alias("last_day")
        )
        customer = self.table("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
        places = self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        # Versions of the second half of a year live one nation further on.
        moved = F.pmod(
            F.col("c_nationkey") + F.when(F.month("day") > 6, 1).otherwise(0), F.lit(25)
        )
        return (
            versions.join(life, "o_custkey")
            .join(customer, F.col("o_custkey") == F.col("c_custkey"))
            .join(places, moved == F.col("n_nationkey"))
            .select(
                F.col("c_custkey").cast("string").alias("customer_id"),
                F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.col("n_name"))
                .otherwise(F.concat_ws(", ", "n_name", "r_name"))
                .alias("city"),
                F.col("first_day").alias("first_purchase_date"),
                F.col("last_day").alias("latest_login_date"),
                F.col("last_day").alias("latest_purchase_date"),
                (F.pmod("c_custkey", F.lit(3)) == 0).alias("opt_in_status"),
                F.col("tier").isin("1-URGENT", "2-HIGH", "3-MEDIUM").alias("plus_status"),
                F.col("tier").alias("plus_tier"),
                F.col("first_day").alias("registration_date"),
                pick(GENDERS, F.col("c_custkey")).alias("user_gender"),
                F.col("day").alias("valid_from"),
            )
        )

    @cached_property
    def transactions(self) -> DataFrame:
        """Orders; some carry a missing, blank or malformed customer id."""
        key, customer = F.col("o_orderkey"), F.col("o_custkey").cast("string")
        return self.table("orders").select(
            key.cast("string").alias("transaction_id"),
            F.col("o_orderdate").cast("date").alias("date"),
            F.concat_ws("-", customer, F.col("o_orderdate").cast("date")).alias("session_id"),
            F.when(F.col("o_orderpriority") == "1-URGENT", "EXPRESS").alias("transaction_coupon"),
            F.col("o_totalprice").alias("transaction_revenue"),
            F.lit(0.0).alias("transaction_shipping"),
            F.col("o_totalprice").alias("transaction_total"),
            F.concat(F.lit("c"), customer).alias("user_cookie_id"),
            F.when(F.pmod(key, F.lit(23)) == 0, F.lit(None))
            .when(F.pmod(key, F.lit(19)) == 0, F.lit(" "))
            .when(F.pmod(key, F.lit(17)) == 0, F.concat(F.lit("x"), customer))
            .otherwise(customer)
            .alias("customer_id"),
        )

    @staticmethod
    def unit_key() -> Column:
        """Order, part and price in cents identify an order line."""
        cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
        return conformed_key("l_orderkey", "l_partkey", cents).cast("string")

    @cached_property
    def transactionsanditems(self) -> DataFrame:
        return self.table("lineitem").select(
            self.unit_key().alias("item_id"),
            F.col("l_orderkey").cast("string").alias("transaction_id"),
            F.col("l_partkey").cast("string").alias("product_id"),
            F.col("l_shipdate").cast("date").alias("date"),
            F.col("l_extendedprice").alias("item_price"),
            F.col("l_quantity").cast("bigint").alias("item_quantity"),
        )

    @cached_property
    def funnelevents(self) -> DataFrame:
        """One purchase event per order line, its line number giving the hour."""
        shipped = F.col("l_shipdate")
        return self.table("lineitem").select(
            shipped.cast("date").alias("date"),
            F.lit(None).cast("string").alias("device_category"),
            F.lit("purchase").alias("event_name"),
            (shipped + F.make_dt_interval(hours="l_linenumber")).alias("event_time"),
            F.col("l_partkey").cast("string").alias("item_id"),
            F.concat_ws("-", F.col("l_orderkey").cast("string"), shipped.cast("date")).alias(
                "session_id"
            ),
            F.col("l_orderkey").cast("string").alias("transaction_id"),
            F.lit(None).cast("string").alias("user_cookie_id"),
            F.lit(None).cast("string").alias("customer_id"),
        )

    @cached_property
    def product_returns(self) -> DataFrame:
        return (
            self.table("lineitem")
            .where(F.col("l_returnflag").isin("R", "A"))
            .select(
                F.date_add(F.col("l_shipdate").cast("date"), 7).alias("return_date"),
                F.col("l_orderkey").cast("string").alias("transaction_id"),
                self.unit_key().alias("item_id"),
                F.col("l_partkey").cast("string").alias("product_id"),
                F.lit(1.0).alias("return_quantity"),
                F.when(F.col("l_returnflag") == "R", "Refund")
                .otherwise("Exchange")
                .alias("return_status"),
            )
        )


class EventSources(_Sample):
    """Web events: sessions, funnel, purchases and wide ad numbers."""

    @cached_property
    def events(self) -> DataFrame:
        bucket = F.from_json("props", "k INT")["k"]
        return self.table("events").select(
            "event_id", "user_id", "event_type", "value", "ts",
            F.col("ts").cast("date").alias("day"),
            bucket.alias("k"),
        )

    @staticmethod
    def session_id() -> Column:
        return F.concat_ws("-", F.col("user_id").cast("string"), F.col("day"))

    @staticmethod
    def customer_id() -> Column:
        """Three users in ten browse without logging in."""
        logged_in = F.pmod("user_id", F.lit(10)) >= 3
        return F.when(logged_in, F.col("user_id").cast("string"))

    @staticmethod
    def cookie() -> Column:
        return F.concat(F.lit("c"), F.col("user_id").cast("string"))

    @cached_property
    def users(self) -> DataFrame:
        """One version per visiting user, registered on the first active day."""
        seen = self.events.groupBy("user_id").agg(
            F.min("day").alias("first_day"),
            F.max("day").alias("last_day"),
            F.min(F.when(F.col("event_type") == "purchase", F.col("day"))).alias("first_buy"),
            F.max(F.when(F.col("event_type") == "purchase", F.col("day"))).alias("last_buy"),
            (F.count_if(F.col("event_type") == "purchase") >= 5).alias("plus"),
        )
        customer = self.table("customer").select("c_custkey", "c_nationkey")
        places = self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        return (
            seen.join(customer, F.col("user_id") == F.col("c_custkey"))
            .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("user_id").cast("string").alias("customer_id"),
                F.concat_ws(", ", "n_name", "r_name").alias("city"),
                F.col("first_buy").alias("first_purchase_date"),
                F.col("last_day").alias("latest_login_date"),
                F.col("last_buy").alias("latest_purchase_date"),
                (F.pmod("user_id", F.lit(3)) == 0).alias("opt_in_status"),
                F.col("plus").alias("plus_status"),
                F.when(F.col("plus"), "Gold").alias("plus_tier"),
                F.col("first_day").alias("registration_date"),
                pick(GENDERS, F.col("user_id")).alias("user_gender"),
                F.col("first_day").alias("valid_from"),
            )
        )

    @cached_property
    def sessions(self) -> DataFrame:
        """One row per event; the rows of a user's day share a session id."""
        customer = self.table("customer").select("c_custkey", "c_nationkey")
        places = self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        return (
            self.events.join(customer, F.col("user_id") == F.col("c_custkey"), "left")
            .join(places, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select(
                self.session_id().alias("session_id"),
                F.col("day").alias("date"),
                F.when(F.pmod("event_id", F.lit(3)) == 0, F.lit(None))
                .when(F.pmod("user_id", F.lit(4)) == 0, F.col("n_name"))
                .otherwise(F.concat_ws(", ", "n_name", "r_name"))
                .alias("city"),
                pick(DEVICES, F.col("event_id")).alias("device_category"),
                pick(MEDIUMS, F.col("k")).alias("traffic_medium"),
                pick(RAW_SOURCES, F.col("user_id") + F.day("day")).alias("traffic_source"),
                self.cookie().alias("user_cookie_id"),
                self.customer_id().alias("customer_id"),
            )
        )

    @cached_property
    def funnelevents(self) -> DataFrame:
        kind = F.col("event_type")
        name = F.create_map(*[F.lit(x) for pair in EVENT_NAMES.items() for x in pair])
        return self.events.select(
            F.col("day").alias("date"),
            pick(DEVICES, F.col("event_id")).alias("device_category"),
            F.try_element_at(name, kind).alias("event_name"),
            F.col("ts").alias("event_time"),
            F.when(kind.isin("click", "purchase"), F.col("k").cast("string")).alias("item_id"),
            self.session_id().alias("session_id"),
            F.when(kind == "purchase", F.col("event_id").cast("string")).alias("transaction_id"),
            self.cookie().alias("user_cookie_id"),
            self.customer_id().alias("customer_id"),
        )

    @property
    def _purchases(self) -> DataFrame:
        return self.events.where(F.col("event_type") == "purchase")

    @cached_property
    def transactions(self) -> DataFrame:
        shipping = F.when(F.col("value") < 20, 4.5).otherwise(0.0)
        return self._purchases.select(
            F.col("event_id").cast("string").alias("transaction_id"),
            F.col("day").alias("date"),
            self.session_id().alias("session_id"),
            F.when(F.pmod("k", F.lit(5)) == 0, F.concat(F.lit("K"), F.col("k"))).alias(
                "transaction_coupon"
            ),
            F.col("value").alias("transaction_revenue"),
            shipping.alias("transaction_shipping"),
            (F.col("value") + shipping).alias("transaction_total"),
            self.cookie().alias("user_cookie_id"),
            self.customer_id().alias("customer_id"),
        )

    @cached_property
    def transactionsanditems(self) -> DataFrame:
        return self._purchases.select(
            F.col("event_id").cast("string").alias("item_id"),
            F.col("event_id").cast("string").alias("transaction_id"),
            F.col("k").cast("string").alias("product_id"),
            F.col("day").alias("date"),
            F.col("value").alias("item_price"),
            F.lit(1).cast("bigint").alias("item_quantity"),
        )

    @cached_property
    def product_returns(self) -> DataFrame:
        """Purchases below three are sent back."""
        return self._purchases.where(F.col("value") < 3).select(
            F.date_add("day", 7).alias("return_date"),
            F.col("event_id").cast("string").alias("transaction_id"),
            F.col("event_id").cast("string").alias("item_id"),
            F.col("k").cast("string").alias("product_id"),
            F.lit(1.0).alias("return_quantity"),
            F.lit("Refund").alias("return_status"),
        )

    @cached_property
    def adplatform_data(self) -> DataFrame:
        """Wide ad numbers per day: views as impressions, clicks, value as cost."""
        metrics = []
        for slot, platform in enumerate(AD_PLATFORMS):
            mine = F.pmod("k", F.lit(len(AD_PLATFORMS))) == slot
            cost = F.when(mine, F.col("value"))
            metrics += [
                F.count_if(mine & (F.col("event_type") == "view")).alias(f"{platform}_impressions"),
                F.count_if(mine & (F.col("event_type") == "click")).alias(f"{platform}_clicks"),
                money_sum(cost).alias(f"{platform}_cost"),
            ]
        return self.events.groupBy(F.col("day").alias("date")).agg(*metrics)


def raw_listings(spark: SparkSession, folder: str) -> DataFrame:
    """Competitor listings before enrichment, one per part."""
    part = read_table(spark, folder, "part")
    size = F.col("p_size")
    sub_category = F.concat_ws(" ", "p_type", F.substring_index("p_name", " ", 1))
    term = F.concat_ws(" ", F.lit("new"), "p_brand", sub_category, pick(LISTING_GENDERS, size))
    return part.select(
        F.col("p_partkey").cast("string").alias("id"),
        F.when(F.pmod("p_partkey", F.lit(29)) == 0, F.lit(" "))
        .when(F.pmod("p_partkey", F.lit(7)) == 0, F.concat_ws(" ", F.lit("genuine"), "p_name"))
        .otherwise(F.lower(term))
        .alias("search_term"),
        F.when(F.pmod(size, F.lit(5)) == 0, F.concat_ws(" ", "p_name", F.lit("for Girls")))
        .otherwise(F.col("p_name"))
        .alias("title"),
        F.col("p_retailprice").alias("price"),
        pick(CURRENCIES, size).alias("currency"),
        F.lit(None).cast("string").alias("category"),
        F.lit(None).cast("string").alias("brand"),
        pick(CONDITIONS, size).alias("condition"),
        F.concat(F.lit("https://listing.example/"), F.col("p_partkey")).alias("url"),
    )


def listing_json(spark: SparkSession, folder: str) -> DataFrame:
    """The same listings as JSON documents with a nested price."""
    item = F.struct(
        "search_term", "title",
        F.struct(F.col("price").cast("string").alias("value"), "currency").alias("price"),
        F.col("category").alias("categoryPath"), "brand", "condition",
        F.col("url").alias("itemWebUrl"),
    )
    return raw_listings(spark, folder).select(F.to_json(item).alias("item"))
