"""Brand, category and gender of a competitor listing, read from its search term."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.functions.keys import conformed_key
from tillstar.functions.text import (
    capitalize_words, contains_any, strip, title_case, words,
)
from tillstar.sources.schemas import LISTING_JSON

# Brands known by name.
KNOWN_BRANDS = [
    "adidas", "reebok", "nike", "puma", "asics", "new balance", "converse", "vans",
    "under armour", "levis", "jack & jones", "national geographic", "u.s. polo assn.",
    "pierre cardin", "hummel", "calvin klein", "swarovski",
]
# Words dropped at the start of a term, tried once each in this order.
LEADING_WORDS = [
    "new", "latest", "original", "authentic", "genuine", "mens", "women", "womens", "kids",
    "unisex", "ladies", "boys", "girls", "child", "children", "male", "female",
]
# Gender words by priority, found anywhere in the term.
GENDER_WORDS = {
    "womens": ["women", "womens", "woman's", "female", "ladies"],
    "mens": ["men", "mens", "man's", "male"],
    "unisex": ["unisex"],
    "kids": [
        "kids", "child", "children", "boys", "girls", "boy", "girl", "youth", "junior",
    ],
}
# Conditions worth keeping, and the expected currency.
WANTED_CONDITIONS = ["New with box", "New with tags", "New without tags"]
HOME_CURRENCY = "GBP"
UNKNOWN = "Unknown"


def flatten_listings(items: DataFrame) -> DataFrame:
    """Search results as JSON text in column `item` to flat raw listings.

    The id is a hash of address and search term, not a row position.
    """
    parsed = items.select(F.from_json("item", LISTING_JSON).alias("j"))
    return parsed.select(
        conformed_key("j.itemWebUrl", "j.search_term").cast("string").alias("id"),
        F.col("j.search_term").alias("search_term"),
        F.coalesce("j.title", F.lit("")).alias("title"),
        F.col("j.price.value").try_cast("double").alias("price"),
        F.col("j.price.currency").alias("currency"),
        F.col("j.categoryPath").alias("category"),
        F.col("j.brand").alias("brand"),
        F.col("j.condition").alias("condition"),
        F.col("j.itemWebUrl").alias("url"),
    )


def foreign_currency(listings: DataFrame, home: str = HOME_CURRENCY) -> DataFrame:
    """Flag listings priced in another currency than the home one, or in none."""
    return listings.withColumn(
        "is_foreign_currency", ~F.col("currency").eqNullSafe(F.lit(home))
    )


def drop_leading(term: Column) -> Column:
    """Drop each leading word once, in list order."""
    for word in LEADING_WORDS:
        term = F.regexp_replace(term, rf"^{word} \s*", "")
    return term


def _longest_first(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in sorted(values, key=len, reverse=True)])


def _first_in(array: Column, text: Column, test) -> Column:
    """First element for which `test(text, element)` holds.

    The text goes in as an array beside the elements, so its expression is
    evaluated once per row and not once per element.
    """
    beside = F.array_repeat(text, F.size(array))
    hits = F.zip_with(array, beside, lambda item, t: F.when(test(t, item), item))
    return F.try_element_at(F.array_compact(hits), F.lit(1))


def category_list(best_sellers: DataFrame) -> DataFrame:
    """The categories of the best sellers in one array, longest first, ties by rank.

    At most as many entries as best sellers were asked for.
    """
    named = F.col("category").isNotNull() & (F.trim("category") != "")
    ranked = best_sellers.where(named).groupBy("category").agg(
        F.min("rank").alias("rank")
    )
    entry = F.struct((-F.length("category")).alias("size"), "rank", "category")
    listed = F.sort_array(F.collect_list(entry))
    return ranked.agg(F.transform(listed, lambda e: e["category"]).alias("categories"))


def parse_listings(listings: DataFrame, best_sellers: DataFrame, strip_once: bool = False) -> DataFrame:
    """Set brand, category and gender of each listing from its search term.

    The category is the longest best-seller category inside the term; the brand
    is read from the text before it. Leading words are dropped from the term and
    again from the text before the category; `strip_once` skips the second pass,
    which otherwise turns `new new balance` into `Balance`. Everything is column
    expressions; the category list is one row and reaches the tasks as a scalar
    subquery.
    """
    categories = category_list(best_sellers).scalar()
    term = F.lower(strip(F.coalesce("search_term", F.lit(""))))
    staged = listings.drop("brand", "category", "gender").withColumn("__categories", categories)
    staged = staged.withColumn("__blank", term == "").withColumn("__term", drop_leading(term))
    staged = staged.withColumn(
        "__found",
        _first_in(
            F.col("__categories"), F.col("__term"), lambda t, c: F.contains(t, F.lower(c))
        ),
    )
    at = F.instr(F.col("__term"), F.lower(F.col("__found")))
    before = strip(F.col("__term").substr(F.lit(1), at - 1))
    staged = staged.withColumn("__before", before if strip_once else drop_leading(before))

    brands = _longest_first(KNOWN_BRANDS)
    inside = _first_in(brands, F.col("__before"), F.contains)
    leading = _first_in(brands, F.col("__term"), F.startswith)
    staged = staged.withColumn("__inside", inside).withColumn("__leading", leading)

    pieces = words(F.col("__term"))
    empty = F.col("__term") == ""
    before_words = F.when(F.col("__before") == "", UNKNOWN).otherwise(
        capitalize_words(F.col("__before"))
    )
    with_category = F.coalesce(title_case(F.col("__inside")), before_words)
    first_word = F.when(empty, UNKNOWN).otherwise(title_case(F.element_at(pieces, 1)))
    last_word = F.when(empty, UNKNOWN).otherwise(title_case(F.element_at(pieces, -1)))
    without_category = F.coalesce(title_case(F.col("__leading")), first_word)
    known = F.col("__found").isNotNull()
    brand = (
        F.when(F.col("__blank"), UNKNOWN).when(known, with_category).otherwise(without_category)
    )
    category = (
        F.when(F.col("__blank"), UNKNOWN)
        .when(known, title_case(F.col("__found")))
        .otherwise(last_word)
    )
    gender = listing_gender(F.col("search_term"), F.col("title"))
    return staged.withColumns({"brand": brand, "category": category, "gender": gender}).select(
        *listings.drop("brand", "category", "gender").columns, "brand", "category", "gender"
    )


def listing_gender(term: Column, title: Column) -> Column:
    """First gender by priority whose words occur in the term; a unisex term
    with a children's word in its title is for kids."""
    low = F.lower(F.coalesce(term, F.lit("")))
    for_kids = contains_any(F.lower(F.coalesce(title, F.lit(""))), GENDER_WORDS["kids"])
    return (
        F.when(contains_any(low, GENDER_WORDS["womens"]), "womens")
        .when(contains_any(low, GENDER_WORDS["mens"]), "mens")
        .when(contains_any(low, GENDER_WORDS["unisex"]), F.when(for_kids, "kids").otherwise("unisex"))
        .when(contains_any(low, GENDER_WORDS["kids"]), "kids")
        .otherwise("unknown")
    )
