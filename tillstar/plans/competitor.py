"""Competitor listings: search terms, enrichment and the listing star."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.functions.numbers import safe_int
from tillstar.operators.listings import WANTED_CONDITIONS, parse_listings
from tillstar.operators.numbering import dense_key

# Sub-categories that are not searched, and the genders searched for.
SKIPPED_SUB_CATEGORIES = ["Home & Decoration", "Cosmetics & Makeup", "Jewellery"]
SEARCH_GENDERS = ["mens", "womens", "unisex"]
TOP = 100


def best_sellers(
    stg_items: DataFrame,
    stg_attributes: DataFrame,
    own_brand: str,
    skipped: Sequence[str] = SKIPPED_SUB_CATEGORIES,
    n: int = TOP,
) -> DataFrame:
    """The `n` (brand, sub-category) pairs with the most units sold, ranked from 1.

    Units are summed per product before the join, so one line per product
    meets its attributes. Ties go by brand and category.
    """
    sold = stg_items.groupBy("product_id").agg(F.sum("product_quantity").alias("units"))
    sub = F.col("item_sub_category")
    wanted = (
        stg_attributes.where((F.col("item_brand") != own_brand) & ~sub.isin(list(skipped)))
        .select(
            safe_int(F.col("item_id")).alias("product_id"),
            F.col("item_brand").alias("brand"),
            sub.alias("category"),
        )
    )
    demand = (
        sold.join(wanted, "product_id")
        .groupBy("brand", "category")
        .agg(F.sum("units").alias("total_items_sold"))
    )
    top = demand.orderBy(F.desc("total_items_sold"), "brand", "category").limit(n)
    # At most n rows are left: their rank is the number of pairs at or before each.
    order = F.struct((-F.coalesce("total_items_sold", F.lit(0))).alias("u"), "brand", "category")
    listed = top.agg(F.sort_array(F.collect_list(order)).alias("pairs"))
    return listed.select(F.posexplode("pairs").alias("position", "p")).select(
        (F.col("position") + 1).cast("bigint").alias("rank"),
        "p.brand", "p.category",
        (-F.col("p.u")).alias("total_items_sold"),
    )


def search_terms(best: DataFrame) -> DataFrame:
    """Three lower-case terms per best seller, one for each gender."""
    genders = F.array(*[F.lit(g) for g in SEARCH_GENDERS])
    exploded = best.select("rank", "brand", "category", F.explode(genders).alias("gender"))
    return exploded.select(
        "rank", "gender",
        F.lower(F.concat_ws(" ", F.lit("new"), "brand", "category", "gender")).alias(
            "search_term"
        ),
    )


def enrich(raw: DataFrame, best: DataFrame, as_of: Column) -> DataFrame:
    """Raw listings with brand, category and gender, in landing-table shape.

    Keeps the wanted conditions and prefers the best sellers' own spelling of a
    category. Spellings that differ only in case count as one, so a listing is
    never repeated.
    """
    parsed = parse_listings(raw.where(F.col("condition").isin(WANTED_CONDITIONS)), best)
    canonical = best.groupBy(
        F.lower("brand").alias("brand_lower"), F.lower("category").alias("category_lower")
    ).agg(F.min_by("category", "rank").alias("own_category"))
    matched = parsed.join(
        canonical,
        (F.lower("brand") == F.col("brand_lower"))
        & (F.lower("category") == F.col("category_lower")),
        "left",
    )
    return matched.select(
        "id", "search_term", "title", "price", "currency",
        F.coalesce("own_category", "category").alias("category"),
        "brand", "condition", "gender", "url",
        as_of.cast("timestamp").alias("transformation_timestamp"),
    )


def brands(listings: DataFrame) -> DataFrame:
    named = listings.where(F.col("brand").isNotNull()).select("brand").distinct()
    return dense_key(named, "brand_id", ["brand"])


def categories(listings: DataFrame) -> DataFrame:
    named = listings.where(F.col("category").isNotNull()).select("category").distinct()
    return dense_key(named, "category_id", ["category"])


def items(listings: DataFrame, dim_brand: DataFrame, dim_category: DataFrame) -> DataFrame:
    """Listings with both keys; those without brand or category are left out."""
    return (
        listings.join(dim_brand, "brand")
        .join(dim_category, "category")
        .select(
            "id", "search_term", "title", "price", "currency", "brand_id", "category_id",
            "condition", "gender", "url", "transformation_timestamp",
        )
    )
