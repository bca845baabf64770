"""Competitor listings against a row-at-a-time reading of the rules."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillstar.operators.listings import (
    flatten_listings, foreign_currency, listing_gender, parse_listings,
)
from tillstar.plans import competitor

BEST = [(1, "Nike", "t-shirts"), (2, "New Balance", "boots"), (3, "Acme", "rain boots")]


@pytest.fixture(scope="module")
def best(spark):
    return spark.createDataFrame(BEST, "rank bigint, brand string, category string")


def listings(spark, terms, title="x"):
    return spark.createDataFrame(
        [(str(i), t, title) for i, t in enumerate(terms)],
        "id string, search_term string, title string",
    )


def parsed(spark, best, terms, **kw):
    got = parse_listings(listings(spark, terms), best, **kw).orderBy("id").collect()
    return [(r.brand, r.category) for r in got]


def test_brand_and_category(spark, best):
    terms = [
        "new nike t-shirts mens", "new new balance boots womens", "  ", None,
        "acme rain boots", "boots", "PUMA thing", "genuine gizmo lamp", "levis",
    ]
    assert parsed(spark, best, terms) == [
        ("Nike", "T-Shirts"), ("Balance", "Boots"), ("Unknown", "Unknown"),
        ("Unknown", "Unknown"), ("Acme", "Rain Boots"), ("Unknown", "Boots"),
        ("Puma", "Thing"), ("Gizmo", "Lamp"), ("Levis", "Levis"),
    ]


def test_stripping_once_keeps_new_balance(spark, best):
    assert parsed(spark, best, ["new new balance boots"], strip_once=True) == [
        ("New Balance", "Boots")
    ]


def test_known_brand_inside_the_prefix(spark, best):
    assert parsed(spark, best, ["kids jack & jones slim t-shirts", "the u.s. polo assn. boots"]) == [
        ("Jack & Jones", "T-Shirts"), ("U.S. Polo Assn.", "Boots")
    ]


def test_gender(spark):
    rows = [
        ("new nike womens", ""), ("garment", ""), ("x unisex", "kids tee"), ("x unisex", "tee"),
        ("boy hat", ""), ("lamp", "girls"), (None, "boys"),
    ]
    df = spark.createDataFrame(rows, "term string, title string")
    got = [r[0] for r in df.select(listing_gender(F.col("term"), F.col("title"))).collect()]
    assert got == ["womens", "mens", "kids", "unisex", "kids", "unknown", "unknown"]


def test_flatten(spark):
    item = '{"title":"T","price":{"value":"9.5","currency":"USD"},"itemWebUrl":"u","search_term":"s"}'
    df = spark.createDataFrame([(item,), (item.replace('"u"', '"v"'),), ("{}",)], "item string")
    rows = flatten_listings(df).collect()
    assert len({r.id for r in rows}) == 3
    assert (rows[0].price, rows[0].currency, rows[0].title) == (9.5, "USD", "T")
    assert rows[2].title == "" and rows[2].price is None
    flags = [r.is_foreign_currency for r in foreign_currency(flatten_listings(df)).collect()]
    assert flags == [True, True, True]


def test_enrichment_prefers_own_spelling_and_drops_used_goods(spark, best):
    raw = spark.createDataFrame(
        [
            ("1", "new nike t-shirts mens", "t", 1.0, "GBP", None, None, "New with tags", "u1"),
            ("2", "new puma boots", "t", 1.0, "GBP", None, None, "Pre-owned", "u2"),
            ("3", "new zed lamp", "t", 1.0, "GBP", None, None, "New with box", "u3"),
        ],
        "id string, search_term string, title string, price double, currency string, "
        "category string, brand string, condition string, url string",
    )
    out = competitor.enrich(raw, best, F.lit(dt.date(2024, 1, 1))).orderBy("id")
    assert [(r.id, r.brand, r.category) for r in out.collect()] == [
        ("1", "Nike", "t-shirts"), ("3", "Zed", "Lamp")
    ]
    names = out.columns
    assert names.index("gender") == names.index("condition") + 1


def test_best_sellers(spark):
    items = spark.createDataFrame(
        [(1, 5), (2, 9), (3, 9), (4, 50), (5, 70)], "product_id bigint, product_quantity bigint"
    )
    attributes = spark.createDataFrame(
        [
            ("1", "A", "Tops"), ("2", "B", "Boots"), ("3", "A", "Tops"), ("4", "Own", "Tops"),
            ("5", "C", "Jewellery"),
        ],
        "item_id string, item_brand string, item_sub_category string",
    )
    best = competitor.best_sellers(items, attributes, "Own", n=1)
    assert [tuple(r) for r in best.collect()] == [(1, "A", "Tops", 14)]
    terms = [r.search_term for r in competitor.search_terms(best).collect()]
    assert sorted(terms) == ["new a tops mens", "new a tops unisex", "new a tops womens"]
    everything = competitor.best_sellers(items, attributes, "Own")
    assert [r.brand for r in everything.orderBy("rank").collect()] == ["A", "B"]


def test_blank_best_seller_category_finds_nothing(spark):
    blank = spark.createDataFrame(
        [(1, "Nike", "", 5), (2, "Nike", None, 4)], "rank int, brand string, category string, n int"
    )
    assert parsed(spark, blank, ["new nike air shoes mens"]) == [("Nike", "Mens")]
