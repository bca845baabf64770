"""The whole warehouse, layer by layer."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.operators.joins import null_spread
from tillstar.plans import competitor, dims, exports, facts, marts, reports, staging
from tillstar.sinks.writers import (
    as_view, commented, settled, settled_by, target_database, write_table,
)


class Warehouse:
    """Lazy DataFrames of every table, built from the source frames on demand.

    `calendar` bounds the date dimension; `built_at` fixes the build time, which
    otherwise is the time a query runs. With `loaded_at` the staging tables carry
    `updated_at` and `loaded_on`, the products the latest `updated_at` of their sources, and
    the activity mart `mart_updated_at`. A table set by `store` replaces its lazy form in
    everything built later.
    """

    def __init__(
        self,
        spark: SparkSession,
        sources: Mapping[str, DataFrame],
        calendar: tuple[dt.date, dt.date] = (dims.CALENDAR_START, dims.CALENDAR_END),
        built_at: Column | None = None,
        loaded_at: Column | None = None,
    ):
        self.spark = spark
        self.src = sources
        self.calendar = calendar
        self.built_at = built_at
        self.loaded_at = loaded_at
        # the day on which the last version of a customer starts, known once they are settled
        self.last_version: Column | None = None

    def _stamped(self, df: DataFrame) -> DataFrame:
        return df if self.loaded_at is None else staging.audited(df, self.loaded_at)

    def store(self, name: str, df: DataFrame) -> DataFrame:
        self.__dict__[name] = df
        if name == "fct_transactions":
            self.__dict__.pop("sold_units", None)
        return df

    def settle(self, *names: str) -> Warehouse:
        """Compute tables that several others read just once, in the order given."""
        for name in names:
            table = getattr(self, name)
            if name in KEYED:
                table, keys = KEYED[name](table)
                self.store(name, settled_by(table, *keys))
            else:
                self.store(name, settled(table))
            if name == "dim_users":
                latest = self.dim_users.agg(F.max("valid_from").cast("date")).first()[0]
                self.last_version = None if latest is None else F.lit(latest)
        return self

    # staging

    @cached_property
    def stg_ad_platform(self):
        return self._stamped(staging.ad_platform(self.src["adplatform_data"]))

    @cached_property
    def stg_ad_platform_unpivoted(self):
        return self._stamped(staging.ad_platform_unpivoted(self.stg_ad_platform))

    @cached_property
    def stg_funnel_events(self):
        return self._stamped(staging.funnel_events(self.src["funnelevents"]))

    @cached_property
    def stg_product_attributes(self):
        return self._stamped(staging.product_attributes(self.src["productattributes"]))

    @cached_property
    def stg_product_costs(self):
        return self._stamped(staging.product_costs(self.src["product_costs"]))

    @cached_property
    def stg_product_list_prices(self):
        return self._stamped(staging.product_list_prices(self.src["product_listprices"]))

    @cached_property
    def stg_product_returns(self):
        return self._stamped(staging.product_returns(self.src["product_returns"]))

    @cached_property
    def stg_sessions(self):
        return self._stamped(staging.sessions(self.src["sessions"]))

    @cached_property
    def stg_transactions(self):
        return self._stamped(staging.transactions(self.src["transactions"]))

    @cached_property
    def stg_transactions_and_items(self):
        return self._stamped(staging.transactions_and_items(self.src["transactionsanditems"]))

    @cached_property
    def stg_users(self):
        return self._stamped(staging.users(self.src["users"], self.src["transactions"]))

    # dimensions

    @cached_property
    def dim_date(self):
        return dims.date(self.spark, *self.calendar)

    @cached_property
    def dim_users(self):
        return dims.users(self.stg_users)

    @cached_property
    def dim_products(self):
        return dims.products(
            self.stg_product_attributes, self.stg_product_list_prices, self.stg_product_costs,
            self.built_at,
        )

    @cached_property
    def dim_brand(self):
        return dims.brand(self.stg_product_attributes)

    @cached_property
    def dim_main_category(self):
        return dims.main_category(self.stg_product_attributes)

    @cached_property
    def dim_sub_category(self):
        return dims.sub_category(self.stg_product_attributes)

    @cached_property
    def geo_locations(self):
        return dims.geo_locations(self.stg_sessions, self.stg_users)

    @cached_property
    def dim_country(self):
        return dims.country(self.geo_locations)

    @cached_property
    def dim_region(self):
        return dims.region(self.geo_locations)

    @cached_property
    def dim_geo(self):
        return dims.geo(self.geo_locations)

    @cached_property
    def dim_source(self):
        return dims.source(self.stg_sessions)

    @cached_property
    def dim_medium(self):
        return dims.medium(self.stg_sessions)

    @cached_property
    def dim_devices(self):
        return dims.devices(self.stg_sessions)

    @cached_property
    def dim_ad_platform(self):
        return dims.ad_platform(self.stg_ad_platform_unpivoted)

    # facts

    @cached_property
    def fct_advertising(self):
        return facts.advertising(self.stg_ad_platform_unpivoted)

    @cached_property
    def fct_sessions(self):
        return facts.sessions(
            self.stg_sessions, self.stg_funnel_events, self.dim_source, self.dim_medium,
            self.dim_geo, self.dim_devices, self.dim_ad_platform,
        )

    @cached_property
    def unit_rows(self):
        return facts.unit_rows(
            self.stg_transactions_and_items, self.stg_transactions, self.stg_product_returns,
            self.stg_funnel_events,
        )

    @cached_property
    def sold_units(self):
        """What the marts need of `fct_transactions`: all but the membership."""
        if "fct_transactions" in self.__dict__:
            return self.fct_transactions.drop("plus_status")
        return facts.described(self.unit_rows)

    @cached_property
    def fct_transactions(self):
        return facts.transactions(self.unit_rows, self.dim_users, self.last_version)

    # marts

    @cached_property
    def product_catalog(self):
        return marts.product_catalog(
            self.dim_products, self.dim_brand, self.dim_sub_category, self.dim_main_category
        )

    @cached_property
    def sales_units(self):
        """What the sales mart needs of units, their order, return and customer."""
        customers = marts.customers_now(self.dim_users)
        rows = facts.unit_rows(
            self.stg_transactions_and_items, self.stg_transactions, self.stg_product_returns,
            self.stg_funnel_events, customers, header_to="transaction_coupon",
        )
        return rows.drop("purchase_time", "return_date")

    @cached_property
    def rpt_transactions(self):
        units = self.sold_units
        if "fct_transactions" not in self.__dict__:
            units = self.sales_units.withColumn("product_revenue", facts.revenue())
        return marts.transactions(
            units, self.dim_date, self.dim_users, self.dim_products, self.dim_brand,
            self.dim_sub_category, self.dim_main_category,
        )

    @cached_property
    def activity_events(self):
        return marts.activity_events(self.sold_units, self.dim_users)

    @cached_property
    def activity_events_as_of(self):
        """Activity with lifetime totals as they stood at each version."""
        return marts.activity_events(self.sold_units, self.dim_users_as_of)

    @cached_property
    def dim_users_as_of(self):
        return marts.lifetime_as_of(self.dim_users, self.stg_transactions)

    @cached_property
    def listed_units(self):
        """What the activity mart needs of units and their product."""
        if "fct_transactions" in self.__dict__:
            units = self.sold_units
        else:
            rows = facts.unit_rows(
                self.stg_transactions_and_items, self.stg_transactions, self.stg_product_returns,
                self.stg_funnel_events, header_to="customer_id",
            )
            units = rows.withColumn("product_revenue", facts.revenue())
        return marts.listed(
            units.select(
                "item_id", "transaction_id", "product_id", "customer_id", "date_key",
                "product_revenue", "product_quantity",
            ),
            self.dim_products, self.dim_brand, self.dim_sub_category, self.dim_main_category,
        )

    @cached_property
    def listed_events(self):
        """`activity_events` with the products that the activity mart shows."""
        return marts.activity_events(self.listed_units, self.dim_users, self.last_version)

    @cached_property
    def listed_events_as_of(self):
        return marts.activity_events(self.listed_units, self.dim_users_as_of, self.last_version)

    def customer_activity(self, events: DataFrame) -> DataFrame:
        return marts.customer_activity(
            events, self.dim_date, self.dim_products, self.dim_brand, self.dim_sub_category,
            self.dim_main_category,
        )

    @cached_property
    def rpt_customer_activity(self):
        events = self.__dict__.get("listed_events")
        rows = self.customer_activity(self.activity_events if events is None else events)
        if self.loaded_at is None:
            return rows
        return rows.withColumn("mart_updated_at", self.loaded_at.cast("timestamp"))

    @cached_property
    def rpt_customer_activity_as_of(self):
        events = self.__dict__.get("listed_events_as_of")
        return self.customer_activity(self.activity_events_as_of if events is None else events)

    def channel_performance(
        self, start: dt.date | None = None, end: dt.date | None = None
    ) -> DataFrame:
        return marts.daily_channel_performance(
            self.fct_advertising, self.fct_sessions, self.sold_units, self.dim_users,
            self.dim_date, self.dim_ad_platform, start, end,
        )

    @cached_property
    def rpt_daily_channel_performance(self):
        return self.channel_performance()

    # exports and reports

    @cached_property
    def daily_spend_metrics(self):
        return exports.daily_spend_metrics(
            self.fct_advertising, self.dim_ad_platform, self.dim_source, self.fct_sessions,
            self.sold_units,
        )

    @cached_property
    def weekly_brand_sales(self):
        return exports.weekly_brand_sales(self.sold_units, self.product_catalog)

    @cached_property
    def weekly_ad_spend(self):
        return exports.weekly_ad_spend(self.stg_ad_platform_unpivoted)

    @cached_property
    def weekly_signups(self):
        return exports.weekly_signups(self.stg_users)

    @cached_property
    def monthly_channel_performance(self):
        return reports.monthly_channel_performance(self.rpt_daily_channel_performance)

    @cached_property
    def category_profitability(self):
        return reports.category_profitability(self.sold_units, self.product_catalog)

    @cached_property
    def average_order_value(self):
        return reports.average_order_value(self.sold_units)

    @cached_property
    def activity_mix(self):
        return reports.activity_mix(self.activity_events)

    @cached_property
    def top_customers(self):
        return reports.top_customers(self.dim_users)

    @cached_property
    def session_engagement(self):
        return reports.session_engagement(self.fct_sessions, self.dim_date)


def _by_product(units: DataFrame) -> tuple[DataFrame, list[str]]:
    spread = null_spread(F.col("product_id").isNull(), "item_id")
    return units.withColumn("__spread", spread), ["product_id", "__spread"]


def _by_customer(versions: DataFrame) -> tuple[DataFrame, list[str]]:
    return versions, ["customer_id"]


# Settled tables whose rows are stored by the columns that the next step wants them by.
KEYED = {
    "dim_users": _by_customer,
    "dim_users_as_of": _by_customer,
    "sales_units": _by_product,
    "listed_events": marts.by_group,
    "listed_events_as_of": marts.by_group,
}
# Tables of each layer in the order they are built, with their descriptions.
STAGING = {
    "stg_ad_platform": "Ad numbers per day, one column per platform and metric",
    "stg_ad_platform_unpivoted": "Ad numbers per day and platform",
    "stg_funnel_events": "Typed funnel events",
    "stg_product_attributes": "Products",
    "stg_product_costs": "Product costs",
    "stg_product_list_prices": "Product list prices",
    "stg_product_returns": "Returned units",
    "stg_sessions": "One row per session",
    "stg_transactions": "Typed order headers",
    "stg_transactions_and_items": "Typed units sold",
    "stg_users": "Customer versions with order totals",
}
CORE = {
    "dim_date": "Calendar",
    "dim_users": "Customer versions with validity",
    "dim_products": "Current products",
    "dim_brand": "Brands",
    "dim_main_category": "Main categories",
    "dim_sub_category": "Sub-categories",
    "geo_locations": "Cities seen, split into city and region",
    "dim_country": "Countries",
    "dim_region": "Regions",
    "dim_geo": "Cities",
    "dim_source": "Traffic sources",
    "dim_medium": "Traffic mediums",
    "dim_devices": "Devices",
    "dim_ad_platform": "Ad platforms and channels",
    "fct_advertising": "Ad numbers per day and platform",
    "fct_sessions": "One row per session",
    "fct_transactions": "One row per unit sold",
    "activity_events": "Profile changes and purchases, not yet in order",
}
MARTS = {
    "rpt_transactions": "Units sold with profit and refunds",
    "rpt_customer_activity": "Profile changes and purchases per customer",
    "rpt_daily_channel_performance": "Spend, visits and sales per day and platform",
}
# Facts and marts that grow with sales and visits are stored by year, in `year_part`.
BY_YEAR = {
    "fct_sessions": "date_key",
    "fct_transactions": "date_key",
    "rpt_transactions": "date_key",
    "activity_events": "activity_date",
    "rpt_customer_activity": "activity_date",
}


def build(
    house: Warehouse,
    env: str,
    base: str,
    column_comments: Mapping[str, Mapping[str, str]] | None = None,
    write: Callable[..., DataFrame] = write_table,
) -> Warehouse:
    """Full refresh: staging as views except customers, core and marts as stored tables.

    Every later table reads the stored ones, so no layer is computed twice and
    a lost executor repeats one table at most.
    """
    comments = column_comments or {}
    for name, text in STAGING.items():
        df = commented(getattr(house, name), comments.get(name, {}))
        if name in ("stg_users", "stg_sessions"):
            database = target_database("staging", env, base)
            house.store(name, write(df, f"{database}.{name}", comment=text))
        else:
            house.store(name, as_view(df, name))
    for layer, tables in (("core", CORE), ("marts", MARTS)):
        database = target_database(layer, env, base)
        for name, text in tables.items():
            df = commented(getattr(house, name), comments.get(name, {}))
            parts: tuple[str, ...] = ()
            if name in BY_YEAR:
                day = F.col(BY_YEAR[name])
                if BY_YEAR[name] == "date_key":
                    df = df.withColumn("year_part", F.floor(day / 10000).cast("int"))
                else:
                    df = df.withColumn("year_part", F.year(day))
                parts = ("year_part",)
            stored = write(df, f"{database}.{name}", partition_by=parts, comment=text)
            house.store(name, stored)
    return house


def competitor_star(
    raw_listings: DataFrame,
    stg_items: DataFrame,
    stg_attributes: DataFrame,
    own_brand: str,
    as_of: Column,
) -> dict[str, DataFrame]:
    """Best sellers, search terms, enriched listings and the listing star.

    Best sellers and listings are computed once: several tables read them.
    """
    best = settled(competitor.best_sellers(stg_items, stg_attributes, own_brand))
    listings = settled(competitor.enrich(raw_listings, best, as_of))
    brand, category = competitor.brands(listings), competitor.categories(listings)
    return {
        "best_sellers": best,
        "search_terms": competitor.search_terms(best),
        "competitor_listings": listings,
        "competitor_dim_brand": brand,
        "competitor_dim_category": category,
        "competitor_fct_items": competitor.items(listings, brand, category),
    }
