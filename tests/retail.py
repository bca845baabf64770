"""A tiny retailer in source shape, small enough to check by hand."""

import datetime as dt

from tillstar.sources import schemas

D = dt.date
T = dt.datetime


def sources(spark):
    def frame(name, rows):
        schema = schemas.SOURCES[name]
        names = schema.fieldNames()
        return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)

    def visit(session, day, customer, city, source="google", device="desktop"):
        return dict(
            session_id=session, date=day, city=city, device_category=device,
            traffic_medium="cpc", traffic_source=source, user_cookie_id="c" + session,
            customer_id=customer,
        )

    def event(session, day, name, second, item=None, order=None):
        return dict(
            date=day, device_category="desktop", event_name=name,
            event_time=T(day.year, day.month, day.day, 10, 0, second), item_id=item,
            session_id=session, transaction_id=order, user_cookie_id="c" + session,
        )

    def version(customer, start, city, plus, tier):
        return dict(
            customer_id=customer, city=city, opt_in_status=True, plus_status=plus, plus_tier=tier,
            registration_date=D(2024, 1, 1), user_gender="F", valid_from=start,
        )

    day = D(2024, 1, 10)
    google = dict(google_impressions=100, google_clicks=10, google_cost=20.0)
    return {
        "productattributes": frame("productattributes", [
            dict(item_id="1", item_brand="Acme", item_name="Tee", item_main_category="Clothes",
                 item_sub_category="Tops", item_gender="men"),
            dict(item_id="2", item_brand="Bolt", item_name="Boot", item_main_category="Shoes",
                 item_sub_category="Boots", item_gender="women"),
        ]),
        "product_costs": frame("product_costs", [
            dict(item_id="1", cost_of_item=4.0), dict(item_id="2", cost_of_item=30.0)]),
        "product_listprices": frame("product_listprices", [
            dict(item_id="1", item_list_price=10.0), dict(item_id="2", item_list_price=50.0)]),
        "users": frame("users", [
            version("7", D(2024, 1, 1), "Austin, TX", False, None),
            version("7", D(2024, 2, 1), "Austin, MN", True, "Gold"),
            version("7", D(2024, 3, 1), "Austin, MN", True, None),
            version("8", D(2024, 1, 5), "Austin", False, None),
            version("bad", D(2024, 1, 5), "Nowhere", False, None),
        ]),
        "sessions": frame("sessions", [
            visit("s1", day, "7", "Austin, TX", "YouTube"),
            visit("s2", day, None, "Austin", "google", "tablet"),
            visit("s3", day, "8", None, "newsletter"),
        ]),
        "funnelevents": frame("funnelevents", [
            event("s1", day, "page_view", 0),
            event("s1", day, "add_to_cart", 5, "1"),
            event("s1", day, "purchase", 30, "1", "100"),
            event("s1", day, "purchase", 31, "1", "100"),
            event("s2", day, "page_view", 0),
        ]),
        "transactions": frame("transactions", [
            dict(transaction_id="100", date=day, session_id="s1", transaction_coupon="X",
                 transaction_revenue=70.0, transaction_shipping=5.0, transaction_total=75.0,
                 user_cookie_id="cs1", customer_id="7"),
            dict(transaction_id="101", date=D(2024, 2, 1), session_id="s9",
                 transaction_revenue=10.0, transaction_shipping=0.0, transaction_total=0.0,
                 user_cookie_id="cs9", customer_id=" "),
        ]),
        "transactionsanditems": frame("transactionsanditems", [
            dict(item_id="1001", transaction_id="100", product_id="1", date=day, item_price=10.0,
                 item_quantity=1),
            dict(item_id="1002", transaction_id="100", product_id="1", date=day, item_price=10.0,
                 item_quantity=1),
            dict(item_id="1003", transaction_id="100", product_id="2", date=day, item_price=50.0,
                 item_quantity=1),
            dict(item_id="1004", transaction_id="101", product_id="1", date=D(2024, 2, 1),
                 item_price=10.0, item_quantity=1),
        ]),
        "product_returns": frame("product_returns", [
            dict(return_date=D(2024, 1, 15), transaction_id="100", item_id="1001", product_id="1",
                 return_quantity=1.0, return_status="Refund"),
            dict(return_date=D(2024, 1, 16), transaction_id="100", item_id="1003", product_id="2",
                 return_quantity=1.0, return_status="Exchange"),
        ]),
        "adplatform_data": frame("adplatform_data", [
            dict(date=day, **google, meta_impressions=0, meta_clicks=0, meta_cost=0.0)]),
    }
