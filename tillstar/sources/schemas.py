"""Declared schemas of the source tables. Every id arrives as text."""

from __future__ import annotations

from pyspark.sql import types as T

STRING = T.StringType()
LONG = T.LongType()
DOUBLE = T.DoubleType()
DATE = T.DateType()
BOOLEAN = T.BooleanType()
DATETIME = T.TimestampNTZType()
TIMESTAMP = T.TimestampType()


def _table(**columns) -> T.StructType:
    """Column types by name; a (type, "required") pair marks a column that may not be null."""
    fields = []
    for name, spec in columns.items():
        kind, nullable = (spec[0], False) if isinstance(spec, tuple) else (spec, True)
        fields.append(T.StructField(name, kind, nullable))
    return T.StructType(fields)


def _required(kind):
    return (kind, "required")


AD_PLATFORMS = ["criteo", "google", "meta", "rtbhouse", "tiktok"]
AD_METRICS = {"impressions": LONG, "clicks": LONG, "cost": DOUBLE}

# Source tables with their columns and types.
SOURCES: dict[str, T.StructType] = {
    "adplatform_data": _table(
        date=_required(DATE),
        **{f"{p}_{m}": kind for p in AD_PLATFORMS for m, kind in AD_METRICS.items()},
    ),
    "funnelevents": _table(
        date=_required(DATE), device_category=STRING, event_name=_required(STRING),
        event_time=_required(DATETIME), item_id=STRING, session_id=_required(STRING),
        transaction_id=STRING, user_cookie_id=STRING, customer_id=STRING,
    ),
    "product_costs": _table(item_id=_required(STRING), cost_of_item=_required(DOUBLE)),
    "product_listprices": _table(item_id=_required(STRING), item_list_price=_required(DOUBLE)),
    "product_returns": _table(
        return_date=_required(DATE), transaction_id=_required(STRING), item_id=_required(STRING),
        product_id=_required(STRING), return_quantity=DOUBLE, return_status=STRING,
    ),
    "productattributes": _table(
        item_id=_required(STRING), item_brand=STRING, item_gender=STRING,
        item_main_category=STRING, item_name=STRING, item_sub_category=STRING,
    ),
    "sessions": _table(
        session_id=_required(STRING), date=_required(DATE), city=STRING, device_category=STRING,
        traffic_medium=STRING, traffic_source=STRING, user_cookie_id=STRING, customer_id=STRING,
    ),
    "transactions": _table(
        transaction_id=_required(STRING), date=_required(DATE), session_id=_required(STRING),
        transaction_coupon=STRING, transaction_revenue=DOUBLE, transaction_shipping=DOUBLE,
        transaction_total=DOUBLE, user_cookie_id=STRING, customer_id=STRING,
    ),
    "transactionsanditems": _table(
        item_id=_required(STRING), transaction_id=_required(STRING), product_id=_required(STRING),
        date=_required(DATE), item_price=DOUBLE, item_quantity=LONG,
    ),
    "users": _table(
        customer_id=_required(STRING), city=STRING, first_purchase_date=DATE,
        latest_login_date=DATE, latest_purchase_date=DATE, opt_in_status=BOOLEAN,
        plus_status=BOOLEAN, plus_tier=STRING, registration_date=DATE, user_gender=STRING,
        valid_from=_required(DATE),
    ),
    "competitor_listings": _table(
        id=_required(STRING), search_term=STRING, title=_required(STRING), price=DOUBLE,
        currency=STRING, category=STRING, brand=STRING, condition=STRING, gender=STRING,
        url=_required(STRING), transformation_timestamp=_required(TIMESTAMP),
    ),
}

RETAIL_TABLES = [name for name in SOURCES if name != "competitor_listings"]

RAW_LISTINGS = _table(
    id=STRING, search_term=STRING, title=STRING, price=DOUBLE, currency=STRING, category=STRING,
    brand=STRING, condition=STRING, url=STRING,
)

# One search result as JSON, price nested.
LISTING_JSON = T.StructType(
    [
        T.StructField("search_term", STRING),
        T.StructField("title", STRING),
        T.StructField(
            "price",
            T.StructType([T.StructField("value", STRING), T.StructField("currency", STRING)]),
        ),
        T.StructField("categoryPath", STRING),
        T.StructField("brand", STRING),
        T.StructField("condition", STRING),
        T.StructField("itemWebUrl", STRING),
    ]
)
