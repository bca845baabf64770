"""Reference SQL for the named queries, in DuckDB's dialect.

Each query is a SELECT over named blocks; a block lists the blocks it needs and
all of them become CTEs. `o_` blocks describe the order shape of the sample
tables, `e_` blocks the web event shape.
"""

from __future__ import annotations

from contract import values
from contract.values import AD_PLATFORMS

BUILD_DAY = "DATE '2024-02-01'"


def key(*fields: str) -> str:
    parts = ", ".join(f"coalesce(CAST({f} AS VARCHAR), '_null_')" for f in fields)
    return f"CAST('0x' || substr(md5(concat_ws('|', {parts})), 1, 15) AS BIGINT)"


def day_key(day: str) -> str:
    return f"CAST(strftime({day}, '%Y%m%d') AS BIGINT)"


def week(day: str) -> str:
    return f"CAST(strftime({day}, '%U') AS INTEGER)"


def money(value: str) -> str:
    return f"CAST(sum(CAST({value} AS DECIMAL(28,6))) AS DOUBLE)"


def ratio(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0))"


def texts(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def pick(values: list[str], index: str) -> str:
    return f"([{texts(values)}])[CAST({index} AS BIGINT) % {len(values)} + 1]"


def grouped(value: str, groups: dict, default: str) -> str:
    cases = " ".join(f"WHEN {value} IN ({texts(a)}) THEN '{g}'" for g, a in groups.items())
    return f"CASE {cases} ELSE {default} END"


def by_substring(value: str, rules, default: str) -> str:
    cases = " ".join(
        "WHEN " + " OR ".join(f"contains(lower({value}), '{n}')" for n in needles)
        + f" THEN '{label}'"
        for needles, label in rules
    )
    return f"CASE {cases} ELSE {default} END"


def state(plus: str, orders: str) -> str:
    return (
        f"CASE WHEN {plus} THEN 'Premium Customer' WHEN {orders} >= 5 THEN 'Loyal Customer' "
        f"WHEN {orders} >= 2 THEN 'Repeat Customer' ELSE 'New Customer' END"
    )


def title(value: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all({value}, '([a-zA-Z]+|[^a-zA-Z]+)'), "
        "lambda w: upper(w[1]) || lower(w[2:])), '')"
    )


def capitals(value: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_split_to_array(trim({value}), '\\s+'), "
        "lambda w: upper(w[1]) || lower(w[2:])), ' ')"
    )


GENDERS = ["M", "F", "Non-binary", "Unknown"]
PRODUCT_GENDERS = ["men", "women", "unisex", "kids"]
DEVICES = ["desktop", "mobile", "tablet", "unknown"]
RAW_SOURCES = [
    "google", "YouTube.com", "facebook", " l.instagram.com ", "TikTok", "awin", "dv360", "bing",
]
MEDIUMS = [
    "organic", "paid", "email", "social", "direct", "referral", "cpc", "display", "(none)", "crm",
]
CONDITIONS = ["New with tags", "New with box", "New without tags", "Pre-owned", "Open box"]

# name -> (blocks needed, SQL)
BLOCKS: dict[str, tuple[str, str]] = {}


def block(name: str, needs: str, sql: str) -> None:
    BLOCKS[name] = (needs, sql)


UNIT_KEY = key("l_orderkey", "l_partkey", "CAST(round(l_extendedprice * 100) AS BIGINT)")

# Order sources.

block("o_attributes", "", f"""
SELECT CAST(p_partkey AS VARCHAR) AS item_id, p_brand AS item_brand,
       {pick(PRODUCT_GENDERS, 'p_size')} AS item_gender, p_type AS item_main_category,
       p_name AS item_name, p_type || ' ' || split_part(p_name, ' ', 1) AS item_sub_category
FROM part""")
block("o_users", "", f"""
SELECT c.c_custkey AS customer_id,
       CASE WHEN c.c_mktsegment = 'HOUSEHOLD' THEN n.n_name
            ELSE n.n_name || ', ' || r.r_name END AS city,
       l.first_day, l.last_day, c.c_custkey % 3 = 0 AS opt_in_status,
       v.tier IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AS plus_status, v.tier AS plus_tier,
       {pick(GENDERS, 'c.c_custkey')} AS user_gender, v.day AS valid_from
FROM (SELECT o_custkey, CAST(o_orderdate AS DATE) AS day,
             arg_max(o_orderpriority, o_orderkey) AS tier
      FROM orders GROUP BY ALL) v
JOIN (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS first_day,
             max(CAST(o_orderdate AS DATE)) AS last_day
      FROM orders GROUP BY ALL) l ON l.o_custkey = v.o_custkey
JOIN customer c ON c.c_custkey = v.o_custkey
JOIN nation n ON n.n_nationkey = (c.c_nationkey + (CASE WHEN month(v.day) > 6 THEN 1 ELSE 0 END)) % 25
JOIN region r ON r.r_regionkey = n.n_regionkey""")
block("o_transactions", "", """
SELECT o_orderkey AS transaction_id, CAST(o_orderdate AS DATE) AS date,
       o_custkey || '-' || CAST(o_orderdate AS DATE) AS session_id,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'EXPRESS' END AS transaction_coupon,
       o_totalprice AS transaction_revenue, 0.0::DOUBLE AS transaction_shipping,
       o_totalprice AS transaction_total, 'c' || o_custkey AS user_cookie_id,
       CASE WHEN o_orderkey % 23 = 0 OR o_orderkey % 19 = 0 OR o_orderkey % 17 = 0 THEN NULL
            ELSE o_custkey END AS customer_id,
       CASE WHEN o_orderkey % 23 = 0 THEN NULL WHEN o_orderkey % 19 = 0 THEN ' '
            WHEN o_orderkey % 17 = 0 THEN 'x' || o_custkey
            ELSE CAST(o_custkey AS VARCHAR) END AS raw_customer
FROM orders""")
block("o_items", "", f"""
SELECT CAST(l_shipdate AS DATE) AS date, {UNIT_KEY} AS item_id, l_orderkey AS transaction_id,
       l_partkey AS product_id, l_extendedprice AS product_price,
       CAST(l_quantity AS BIGINT) AS product_quantity
FROM lineitem""")
block("o_returns", "", f"""
SELECT CAST(l_shipdate AS DATE) + 7 AS return_date, l_orderkey AS transaction_id,
       {UNIT_KEY} AS item_id, l_partkey AS product_id, 1.0::DOUBLE AS return_quantity,
       CASE WHEN l_returnflag = 'R' THEN 'Refund' ELSE 'Exchange' END AS return_status
FROM lineitem WHERE l_returnflag IN ('R', 'A')""")
block("o_times", "", """
SELECT l_orderkey AS transaction_id, l_partkey AS product_id,
       min(l_shipdate + to_hours(l_linenumber)) AS event_time
FROM lineitem GROUP BY ALL""")

# Web event sources.

block("e_events", "", """
SELECT event_id, user_id, event_type, value, ts, CAST(ts AS DATE) AS day,
       CAST(json_extract(props, '$.k') AS INTEGER) AS k,
       user_id || '-' || CAST(ts AS DATE) AS session_id, 'c' || user_id AS user_cookie_id,
       CASE WHEN user_id % 10 >= 3 THEN user_id END AS customer_id
FROM events""")
block("e_attributes", "o_attributes", "SELECT * FROM o_attributes")
block("e_users", "e_events", f"""
SELECT s.user_id AS customer_id, n.n_name || ', ' || r.r_name AS city, s.first_day, s.last_day,
       s.first_buy, s.last_buy, s.user_id % 3 = 0 AS opt_in_status, s.buys >= 5 AS plus_status,
       CASE WHEN s.buys >= 5 THEN 'Gold' END AS plus_tier,
       {pick(GENDERS, 's.user_id')} AS user_gender, s.first_day AS valid_from
FROM (SELECT user_id, min(day) AS first_day, max(day) AS last_day,
             min(day) FILTER (event_type = 'purchase') AS first_buy,
             max(day) FILTER (event_type = 'purchase') AS last_buy,
             count(*) FILTER (event_type = 'purchase') AS buys
      FROM e_events GROUP BY user_id) s
JOIN customer c ON c.c_custkey = s.user_id
JOIN nation n ON n.n_nationkey = c.c_nationkey
JOIN region r ON r.r_regionkey = n.n_regionkey""")
block("e_raw_sessions", "e_events", f"""
SELECT e.session_id, e.day AS date,
       CASE WHEN e.event_id % 3 = 0 THEN NULL WHEN e.user_id % 4 = 0 THEN n.n_name
            ELSE n.n_name || ', ' || r.r_name END AS city,
       {pick(DEVICES, 'e.event_id')} AS device_category, {pick(MEDIUMS, 'e.k')} AS traffic_medium,
       {pick(RAW_SOURCES, '(e.user_id + day(e.day))')} AS traffic_source,
       e.user_cookie_id, e.customer_id
FROM e_events e
LEFT JOIN customer c ON c.c_custkey = e.user_id
LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
LEFT JOIN region r ON r.r_regionkey = n.n_regionkey""")
block("e_stg_sessions", "e_raw_sessions", f"""
SELECT session_id, min(date) AS start_date, max(date) AS end_date, count(*) AS session_count,
       min(user_cookie_id) AS user_cookie_id, min(customer_id) AS customer_id, min(city) AS city,
       min({grouped('lower(trim(traffic_source))', values.TRAFFIC_SOURCES, 'traffic_source')})
         AS traffic_source,
       min(traffic_medium) AS traffic_medium, min(device_category) AS device_category
FROM e_raw_sessions GROUP BY session_id""")
block("e_funnel", "e_events", f"""
SELECT day AS date, ts AS event_time, user_cookie_id, customer_id, session_id,
       {pick(DEVICES, 'event_id')} AS device_category,
       CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'add_to_cart'
            WHEN 'signup' THEN 'begin_checkout' WHEN 'error' THEN 'remove_from_cart'
            WHEN 'purchase' THEN 'purchase' END AS event_name,
       CASE WHEN event_type IN ('click', 'purchase') THEN CAST(k AS BIGINT) END AS item_id,
       CASE WHEN event_type = 'purchase' THEN event_id END AS transaction_id
FROM e_events""")
block("e_transactions", "e_events", """
SELECT event_id AS transaction_id, day AS date, session_id,
       CASE WHEN k % 5 = 0 THEN 'K' || k END AS transaction_coupon, value AS transaction_revenue,
       CASE WHEN value < 20 THEN 4.5::DOUBLE ELSE 0.0::DOUBLE END AS transaction_shipping,
       value + (CASE WHEN value < 20 THEN 4.5::DOUBLE ELSE 0.0::DOUBLE END) AS transaction_total,
       user_cookie_id, customer_id
FROM e_events WHERE event_type = 'purchase'""")
block("e_items", "e_events", """
SELECT day AS date, event_id AS item_id, event_id AS transaction_id, CAST(k AS BIGINT) AS product_id,
       value AS product_price, CAST(1 AS BIGINT) AS product_quantity
FROM e_events WHERE event_type = 'purchase'""")
block("e_returns", "e_events", """
SELECT day + 7 AS return_date, event_id AS transaction_id, event_id AS item_id,
       CAST(k AS BIGINT) AS product_id, 1.0::DOUBLE AS return_quantity, 'Refund' AS return_status
FROM e_events WHERE event_type = 'purchase' AND value < 3""")
block("e_times", "e_funnel", """
SELECT transaction_id, item_id AS product_id, min(event_time) AS event_time
FROM e_funnel WHERE transaction_id IS NOT NULL AND item_id IS NOT NULL GROUP BY ALL""")
block("e_ad_wide", "e_events", "SELECT day AS date, " + ", ".join(
    f"count(*) FILTER (k % 5 = {i} AND event_type = 'view') AS {p}_impressions, "
    f"count(*) FILTER (k % 5 = {i} AND event_type = 'click') AS {p}_clicks, "
    f"CAST(sum(CAST(value AS DECIMAL(28,6))) FILTER (k % 5 = {i}) AS DOUBLE) AS {p}_cost"
    for i, p in enumerate(AD_PLATFORMS)) + " FROM e_events GROUP BY day")
block("e_ad", "e_ad_wide", " UNION ALL ".join(
    f"SELECT date, '{p}' AS ad_platform, {p}_impressions AS impressions, {p}_clicks AS clicks, "
    f"{p}_cost AS cost, {ratio(f'{p}_cost', f'{p}_clicks')} AS cpc FROM e_ad_wide "
    f"WHERE {p}_impressions > 0 OR {p}_clicks > 0 OR {p}_cost > 0" for p in AD_PLATFORMS))

# Layers common to both shapes.

for p in ("o", "e"):
    buys = "first_day AS first_purchase_date" if p == "o" else "first_buy AS first_purchase_date"
    last = "last_day" if p == "o" else "last_buy"
    joined_on = (
        "WHERE regexp_matches(trim(raw_customer), '^[0-9]+$')" if p == "o"
        else "WHERE customer_id IS NOT NULL"
    )
    block(f"{p}_totals", f"{p}_transactions", f"""
SELECT customer_id, count(DISTINCT transaction_id) AS transaction_count,
       {money('transaction_total')} AS total_revenue
FROM {p}_transactions {joined_on} GROUP BY customer_id""")
    block(f"{p}_stg_users", f"{p}_users {p}_totals", f"""
SELECT u.customer_id, u.city, u.user_gender, u.first_day AS registration_date,
       u.last_day AS latest_login_date, u.{buys}, u.{last} AS latest_purchase_date,
       u.valid_from, u.opt_in_status, u.plus_status, u.plus_tier,
       coalesce(t.transaction_count, 0) AS transaction_count,
       coalesce(t.total_revenue, 0.0::DOUBLE) AS total_revenue
FROM {p}_users u LEFT JOIN {p}_totals t USING (customer_id)""")
    block(f"{p}_dim_users", f"{p}_stg_users", f"""
SELECT {key('customer_id', 'valid_from')} AS user_key, customer_id, city, user_gender AS gender,
       opt_in_status, plus_status, CASE WHEN plus_status THEN plus_tier END AS plus_tier,
       registration_date, latest_login_date, first_purchase_date,
       latest_purchase_date AS last_purchase_date, transaction_count AS lifetime_orders,
       total_revenue AS lifetime_value, valid_from,
       lead(valid_from) OVER w AS valid_to, lead(valid_from) OVER w IS NULL AS is_current
FROM {p}_stg_users WINDOW w AS (PARTITION BY customer_id ORDER BY valid_from)""")
    block(f"{p}_fct_transactions",
          f"{p}_items {p}_transactions {p}_times {p}_returns {p}_dim_users", f"""
SELECT i.item_id, {day_key('i.date')} AS date_key, t.customer_id, t.user_cookie_id, i.product_id,
       i.transaction_id, strftime(pt.event_time, '%H:%M:%S') AS purchase_time, t.session_id,
       i.product_price, i.product_quantity,
       round(i.product_price * i.product_quantity, 2) AS product_revenue,
       t.transaction_revenue, t.transaction_shipping, t.transaction_total, t.transaction_coupon,
       round({ratio('round(i.product_price * i.product_quantity, 2)', 't.transaction_total')} * 100, 2)
         AS product_contribution_pct,
       CASE WHEN t.transaction_coupon IS NOT NULL THEN 'Discount' ELSE 'Full Price' END AS pricing_type,
       CASE WHEN t.customer_id IS NOT NULL THEN 'Registered' ELSE 'Guest' END AS customer_type,
       CASE WHEN u.plus_status THEN 'true' END AS plus_status,
       r.return_status, r.return_quantity, r.return_date,
       {day_key('r.return_date')} AS return_date_key,
       r.return_status IS NOT NULL AS has_return,
       CASE WHEN i.product_quantity > 0
            THEN round({ratio('coalesce(r.return_quantity, 0)', 'i.product_quantity')} * 100, 2)
            ELSE 0.0::DOUBLE END AS return_rate_pct
FROM {p}_items i
LEFT JOIN {p}_transactions t ON t.transaction_id = i.transaction_id
LEFT JOIN {p}_times pt ON pt.transaction_id = t.transaction_id AND pt.product_id = i.product_id
LEFT JOIN {p}_returns r ON r.item_id = i.item_id
LEFT JOIN {p}_dim_users u ON u.customer_id = t.customer_id AND i.date >= u.valid_from
     AND (u.valid_to IS NULL OR i.date < u.valid_to)""")
    block(f"{p}_rpt", f"{p}_fct_transactions {p}_dim_users products dim_date", f"""
SELECT f.item_id, f.transaction_id, f.date_key, f.customer_id, f.user_cookie_id, f.session_id,
       f.product_id, d.date AS transaction_date, d.year AS transaction_year,
       d.month AS transaction_month, d.day_of_week AS transaction_day_of_week,
       d.quarter AS transaction_quarter, d.is_weekend, d.is_holiday, p.name AS product_name,
       p.brand AS product_brand, p.main_category AS product_main_category,
       p.sub_category AS product_sub_category, p.gender_target AS product_gender_target,
       p.list_price AS product_list_price, u.city AS user_city, u.gender AS user_gender,
       u.registration_date AS user_registration_date, u.lifetime_orders AS user_lifetime_orders,
       u.lifetime_value AS user_lifetime_value, u.plus_status AS user_plus_status,
       f.transaction_coupon IS NOT NULL AS coupon_flag, f.return_status,
       f.product_quantity AS quantity, f.product_revenue AS revenue,
       p.unit_cost * f.product_quantity AS cost,
       f.product_revenue - p.unit_cost * f.product_quantity AS gross_profit,
       CASE WHEN f.return_status = 'Refund' THEN f.product_price * coalesce(f.return_quantity, 0)
            ELSE 0.0::DOUBLE END AS refund_amount,
       f.product_revenue - CASE WHEN f.return_status = 'Refund'
            THEN f.product_price * coalesce(f.return_quantity, 0) ELSE 0.0::DOUBLE END AS net_revenue
FROM {p}_fct_transactions f
LEFT JOIN dim_date d ON d.date_key = f.date_key
LEFT JOIN (SELECT * FROM {p}_dim_users WHERE is_current) u ON u.customer_id = f.customer_id
LEFT JOIN products p ON p.product_id = f.product_id""")
    for users, tag in ((f"{p}_dim_users", ""), (f"{p}_dim_users_as_of", "_as_of")):
        block(f"{p}_changes{tag}", users, f"""
SELECT * EXCLUDE (n), CASE
         WHEN prev_city <> customer_city THEN 'Location Change'
         WHEN prev_plus_status <> plus_status THEN 'Plus Status Change'
         WHEN prev_plus_tier <> plus_tier THEN 'Plus Tier Change'
         WHEN lifetime_value > prev_lifetime_value THEN 'Value Increase'
         ELSE 'Other Change' END AS change_type
FROM (SELECT customer_id, 'profile_change' AS activity_type, valid_from AS activity_date,
             city AS customer_city, gender AS customer_gender, plus_status, plus_tier,
             opt_in_status, lifetime_orders, lifetime_value, lag(city) OVER w AS prev_city,
             lag(plus_status) OVER w AS prev_plus_status, lag(plus_tier) OVER w AS prev_plus_tier,
             lag(lifetime_value) OVER w AS prev_lifetime_value, CAST(NULL AS BIGINT) AS item_id,
             CAST(NULL AS BIGINT) AS transaction_id, CAST(NULL AS BIGINT) AS product_id,
             CAST(NULL AS DOUBLE) AS product_revenue, CAST(NULL AS BIGINT) AS product_quantity,
             {state('plus_status', 'lifetime_orders')} AS customer_state_at_time,
             user_key AS customer_version_key, row_number() OVER w AS n
      FROM {users} WINDOW w AS (PARTITION BY customer_id ORDER BY valid_from))
WHERE n > 1""")
        block(f"{p}_bought{tag}", f"{p}_fct_transactions {users}", f"""
SELECT f.customer_id, 'transaction' AS activity_type,
       CAST(strptime(CAST(f.date_key AS VARCHAR), '%Y%m%d') AS DATE) AS activity_date,
       u.city AS customer_city, u.gender AS customer_gender, u.plus_status, u.plus_tier,
       u.opt_in_status, u.lifetime_orders, u.lifetime_value, CAST(NULL AS VARCHAR) AS prev_city,
       CAST(NULL AS BOOLEAN) AS prev_plus_status, CAST(NULL AS VARCHAR) AS prev_plus_tier,
       CAST(NULL AS DOUBLE) AS prev_lifetime_value, f.item_id, f.transaction_id, f.product_id,
       f.product_revenue, f.product_quantity,
       {state('u.plus_status', 'u.lifetime_orders')} AS customer_state_at_time,
       u.user_key AS customer_version_key, 'Purchase' AS change_type
FROM {p}_fct_transactions f JOIN {users} u ON u.customer_id = f.customer_id
 AND strptime(CAST(f.date_key AS VARCHAR), '%Y%m%d') >= u.valid_from
 AND (u.valid_to IS NULL OR strptime(CAST(f.date_key AS VARCHAR), '%Y%m%d') < u.valid_to)""")
        block(f"{p}_activity{tag}", f"{p}_changes{tag} {p}_bought{tag} products dim_date", f"""
SELECT a.*, a.activity_date + INTERVAL 12 HOURS AS activity_timestamp,
       d.year AS activity_year, d.quarter AS activity_quarter, d.month AS activity_month,
       d.day_of_week AS activity_day_of_week, d.is_weekend AS activity_is_weekend,
       p.brand AS product_brand, p.main_category AS product_category,
       p.list_price AS product_list_price, row_number() OVER w AS customer_activity_sequence,
       lag(a.activity_date) OVER w AS prev_activity_date,
       CAST(a.activity_date - lag(a.activity_date) OVER w AS INTEGER) AS days_since_last_activity,
       CAST(a.activity_date - min(a.activity_date) OVER (PARTITION BY a.customer_id) AS INTEGER)
         AS customer_tenure_days
FROM (SELECT * FROM {p}_changes{tag} UNION ALL BY NAME SELECT * FROM {p}_bought{tag}) a
LEFT JOIN dim_date d ON d.date = a.activity_date
LEFT JOIN products p ON p.product_id = a.product_id
WINDOW w AS (PARTITION BY a.customer_id
             ORDER BY a.activity_date, a.activity_type, a.transaction_id, a.item_id)""")
    block(f"{p}_dim_users_as_of", f"{p}_dim_users {p}_transactions", f"""
SELECT u.* EXCLUDE (lifetime_orders, lifetime_value),
       coalesce(t.orders, 0) AS lifetime_orders, coalesce(t.value, 0.0::DOUBLE) AS lifetime_value
FROM {p}_dim_users u LEFT JOIN (
    SELECT v.customer_id, v.valid_from, count(DISTINCT o.transaction_id) AS orders,
           {money('o.transaction_total')} AS value
    FROM {p}_dim_users v JOIN {p}_transactions o
      ON o.customer_id = v.customer_id AND o.date <= v.valid_from
    GROUP BY ALL) t ON t.customer_id = u.customer_id AND t.valid_from = u.valid_from""")

block("dim_date", "", f"""
SELECT {day_key('day')} AS date_key, CAST(day AS DATE) AS date,
       CAST(dayofweek(day) + 1 AS INTEGER) AS day_of_week, CAST(month(day) AS INTEGER) AS month,
       CAST(quarter(day) AS INTEGER) AS quarter, CAST(year(day) AS INTEGER) AS year,
       dayofweek(day) IN (0, 6) AS is_weekend,
       strftime(day, '%m%d') IN ('1225', '0101', '0704') AS is_holiday
FROM (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2030-12-30', INTERVAL 1 DAY)) AS day)""")
block("products", "", f"""
SELECT p_partkey AS product_id, p_brand AS brand, p_type AS main_category,
       p_type || ' ' || split_part(p_name, ' ', 1) AS sub_category, p_name AS name,
       {pick(PRODUCT_GENDERS, 'p_size')} AS gender_target, p_retailprice AS list_price,
       round(p_retailprice * 0.6::DOUBLE, 2) AS unit_cost
FROM part""")

# Web dimensions and facts.

block("geo", "e_stg_sessions e_stg_users", """
SELECT DISTINCT
       CASE WHEN contains(city, ',') THEN trim(split_part(city, ',', 1)) ELSE city END AS city,
       CASE WHEN contains(city, ',') THEN trim(split_part(city, ',', 2)) END AS region,
       'US' AS country
FROM (SELECT city FROM e_stg_sessions UNION SELECT city FROM e_stg_users)
WHERE city IS NOT NULL AND trim(city) <> ''""")
block("dim_geo", "geo", f"""
SELECT row_number() OVER (ORDER BY country, region NULLS FIRST, city) AS geo_key, city, region,
       CASE WHEN region IS NOT NULL THEN {key('region', 'country')} END AS region_key
FROM geo""")
for name, column in (
    ("source", "traffic_source"), ("medium", "traffic_medium"), ("device", "device_category"),
):
    value = "device_category" if name == "device" else name
    block(f"dim_{name}", "e_stg_sessions", f"""
SELECT row_number() OVER (ORDER BY {column}) AS {name}_key, {column} AS {value},
       min(start_date) AS first_seen, max(end_date) AS last_seen
FROM e_stg_sessions WHERE {column} IS NOT NULL GROUP BY {column}""")
block("dim_ad", "e_ad", f"""
SELECT {key('ad_platform')} AS platform_key, ad_platform AS platform_name,
       {grouped('lower(ad_platform)', values.AD_CHANNELS, "'Other'")} AS channel_type,
       min(date) AS first_seen, max(date) AS last_seen
FROM e_ad GROUP BY ad_platform""")
block("fct_ad", "e_ad", f"""
SELECT {key('date', 'ad_platform')} AS ad_key, {day_key('date')} AS date_key,
       {key('ad_platform')} AS platform_key, coalesce(impressions, 0) AS impressions,
       coalesce(clicks, 0) AS clicks, coalesce(cost, 0.0::DOUBLE) AS cost,
       CASE WHEN impressions > 0 THEN {ratio('coalesce(clicks, 0)', 'impressions')}
            ELSE 0.0::DOUBLE END AS ctr
FROM e_ad""")
block("measures", "e_funnel", """
SELECT *, events = 1 AND page_views = 1 AS bounce_flag
FROM (SELECT session_id, count(*) AS events,
             count(*) FILTER (event_name = 'page_view') AS page_views,
             max(CASE WHEN event_name = 'add_to_cart' THEN 1 ELSE 0 END) AS add_to_cart_flag,
             count(*) FILTER (event_name = 'purchase') AS transaction_count,
             date_sub('second', min(event_time), max(event_time)) AS session_duration
      FROM e_funnel WHERE session_id IS NOT NULL GROUP BY session_id)""")
block("fct_sessions",
      "e_stg_sessions measures dim_source dim_medium dim_device dim_geo dim_ad", f"""
SELECT s.session_id, s.user_cookie_id, {day_key('s.start_date')} AS date_key, s.customer_id,
       ds.source_key, ap.platform_key, dm.medium_key, dg.geo_key, dd.device_key,
       coalesce(m.page_views, 0) AS page_views,
       coalesce(m.add_to_cart_flag = 1, FALSE) AS add_to_cart_flag,
       coalesce(m.bounce_flag, FALSE) AS bounce_flag,
       coalesce(m.transaction_count, 0) AS transaction_count,
       CASE WHEN NOT coalesce(m.bounce_flag, FALSE) THEN m.session_duration END
         AS session_duration_seconds
FROM e_stg_sessions s
LEFT JOIN measures m ON m.session_id = s.session_id
LEFT JOIN dim_source ds ON ds.source = s.traffic_source
LEFT JOIN dim_medium dm ON dm.medium = s.traffic_medium
LEFT JOIN dim_device dd ON dd.device_category = s.device_category
LEFT JOIN dim_geo dg
  ON dg.city = CASE WHEN contains(s.city, ',') THEN trim(split_part(s.city, ',', 1)) ELSE s.city END
 AND dg.region IS NOT DISTINCT FROM
     CASE WHEN contains(s.city, ',') THEN trim(split_part(s.city, ',', 2)) END
LEFT JOIN dim_ad ap ON lower(ap.platform_name) = lower(s.traffic_source)""")
block("channel", "fct_ad dim_date dim_ad fct_sessions e_fct_transactions e_dim_users", f"""
SELECT d.date, {week('d.date')} AS week_number, d.day_of_week, d.month, d.year,
       ap.channel_type AS channel, ap.platform_name AS platform, a.clicks, a.impressions,
       a.cost AS ad_spend, coalesce(v.sessions, 0) AS sessions,
       coalesce(v.total_users, 0) AS total_users, coalesce(v.new_users, 0) AS new_users,
       coalesce(v.bounces, 0) AS bounces, CAST(coalesce(v.page_views, 0) AS BIGINT) AS page_views,
       v.avg_session_duration, coalesce(s.transaction_count, 0) AS transaction_count,
       coalesce(s.total_revenue, 0.0::DOUBLE) AS total_revenue,
       CAST(coalesce(s.item_quantity, 0) AS BIGINT) AS item_quantity,
       coalesce(s.item_price_total, 0.0::DOUBLE) AS item_price_total
FROM fct_ad a
LEFT JOIN dim_date d ON d.date_key = a.date_key
LEFT JOIN dim_ad ap ON ap.platform_key = a.platform_key
LEFT JOIN (
    SELECT f.date_key, f.platform_key, count(DISTINCT f.session_id) AS sessions,
           count(DISTINCT f.customer_id) AS total_users,
           count(DISTINCT CASE WHEN {day_key('u.registration_date')} = f.date_key
                               THEN f.customer_id END) AS new_users,
           count(*) FILTER (f.bounce_flag) AS bounces, sum(f.page_views) AS page_views,
           avg(f.session_duration_seconds) AS avg_session_duration
    FROM fct_sessions f
    LEFT JOIN (SELECT * FROM e_dim_users WHERE is_current) u ON u.customer_id = f.customer_id
    GROUP BY ALL) v ON v.date_key = a.date_key AND v.platform_key = a.platform_key
LEFT JOIN (
    SELECT date_key, platform_key, count(*) AS transaction_count,
           CAST(sum(CAST(revenue AS DECIMAL(28,6))) AS DOUBLE) AS total_revenue,
           sum(quantity) AS item_quantity, CAST(sum(price) AS DOUBLE) AS item_price_total
    FROM (SELECT f.date_key, f.platform_key, t.transaction_id,
                 max(t.transaction_revenue) AS revenue, sum(t.product_quantity) AS quantity,
                 sum(CAST(t.product_price * t.product_quantity AS DECIMAL(28,6))) AS price
          FROM fct_sessions f JOIN e_fct_transactions t
            ON t.session_id = f.session_id AND t.date_key = f.date_key
          GROUP BY ALL)
    GROUP BY ALL) s ON s.date_key = a.date_key AND s.platform_key = a.platform_key""")
block("sourced", "fct_sessions dim_source", """
SELECT f.session_id, f.date_key, s.source
FROM fct_sessions f LEFT JOIN dim_source s ON s.source_key = f.source_key""")
block("sales", "e_fct_transactions sourced", """
SELECT date_key, source, CAST(sum(CAST(total AS DECIMAL(28,6))) AS DOUBLE)
         AS daily_transaction_total, count(transaction_id) AS conversions
FROM (SELECT DISTINCT f.transaction_id, f.date_key, s.source, f.transaction_total AS total
      FROM e_fct_transactions f LEFT JOIN sourced s ON s.session_id = f.session_id)
GROUP BY ALL""")
block("visits", "sourced", """
SELECT date_key, source, count(session_id) AS session_num FROM sourced GROUP BY ALL""")

# Competitor listings.

block("raw_listings", "", f"""
SELECT CAST(p_partkey AS VARCHAR) AS id,
       CASE WHEN p_partkey % 29 = 0 THEN ' '
            WHEN p_partkey % 7 = 0 THEN 'genuine ' || p_name
            ELSE lower('new ' || p_brand || ' ' || p_type || ' ' || split_part(p_name, ' ', 1)
                       || ' ' || {pick(['mens', 'womens', 'unisex'], 'p_size')}) END AS search_term,
       CASE WHEN p_size % 5 = 0 THEN p_name || ' for Girls' ELSE p_name END AS title,
       p_retailprice AS price, {pick(['GBP', 'GBP', 'GBP', 'USD'], 'p_size')} AS currency,
       {pick(CONDITIONS, 'p_size')} AS condition,
       'https://listing.example/' || p_partkey AS url
FROM part""")
block("best", "o_items products", """
SELECT row_number() OVER (ORDER BY total_items_sold DESC, brand, category) AS rank, *
FROM (SELECT p.brand, p.sub_category AS category, CAST(sum(i.product_quantity) AS BIGINT)
               AS total_items_sold
      FROM o_items i JOIN products p ON p.product_id = i.product_id
      WHERE p.brand <> 'Brand#1'
        AND p.sub_category NOT IN ('Home & Decoration', 'Cosmetics & Makeup', 'Jewellery')
      GROUP BY ALL
      ORDER BY total_items_sold DESC, brand, category LIMIT 100)""")
dropped = "lower(trim(coalesce(search_term, '')))"
for word in values.LEADING_WORDS:
    dropped = f"regexp_replace({dropped}, '^{word} +', '')"
before = "trim(substr(term, 1, CAST(instr(term, lower(found)) AS BIGINT) - 1))"
for word in values.LEADING_WORDS:
    before = f"regexp_replace({before}, '^{word} +', '')"
by_length = sorted(values.KNOWN_BRANDS, key=len, reverse=True)
child_words = texts(values.GENDER_WORDS["kids"])
gender_cases = {
    g: f"len(list_filter([{texts(words)}], lambda w: contains(lower(coalesce(search_term, '')), w))) > 0"
    for g, words in values.GENDER_WORDS.items()
}
block("parsed", "raw_listings best", f"""
SELECT id, search_term, title, price, currency, condition, url,
       CASE WHEN blank THEN 'Unknown'
            WHEN found IS NOT NULL THEN coalesce(
                {title(f"list_filter([{texts(by_length)}], lambda b: contains(before, b))[1]")},
                CASE WHEN before = '' THEN 'Unknown' ELSE {capitals('before')} END)
            ELSE coalesce(
                {title(f"list_filter([{texts(by_length)}], lambda b: starts_with(term, b))[1]")},
                CASE WHEN term = '' THEN 'Unknown' ELSE {title("string_split(term, ' ')[1]")} END)
       END AS brand,
       CASE WHEN blank THEN 'Unknown' WHEN found IS NOT NULL THEN {title('found')}
            WHEN term = '' THEN 'Unknown' ELSE {title("string_split(term, ' ')[-1]")} END AS category,
       CASE WHEN {gender_cases['womens']} THEN 'womens' WHEN {gender_cases['mens']} THEN 'mens'
            WHEN {gender_cases['unisex']} THEN
                CASE WHEN len(list_filter([{child_words}], lambda w: contains(lower(title), w))) > 0
                     THEN 'kids' ELSE 'unisex' END
            WHEN {gender_cases['kids']} THEN 'kids' ELSE 'unknown' END AS gender
FROM (SELECT *, {before} AS before
      FROM (SELECT *, list_filter(cats, lambda c: contains(term, lower(c)))[1] AS found
            FROM (SELECT *, trim(coalesce(search_term, '')) = '' AS blank, {dropped} AS term
                  FROM raw_listings),
                 (SELECT list(category ORDER BY length(category) DESC, rank) AS cats
                  FROM (SELECT category, min(rank) AS rank FROM best GROUP BY category))))""")
block("enriched", "parsed best", f"""
SELECT l.id, l.search_term, l.title, l.price, l.currency, coalesce(b.category, l.category) AS category,
       l.brand, l.condition, l.gender, l.url, {BUILD_DAY} AS transformation_timestamp
FROM parsed l
LEFT JOIN (SELECT lower(brand) AS b, lower(category) AS c, arg_min(category, rank) AS category
           FROM best GROUP BY ALL) b ON b.b = lower(l.brand) AND b.c = lower(l.category)
WHERE l.condition IN ('New with box', 'New with tags', 'New without tags')""")
block("comp_brand", "enriched", """
SELECT row_number() OVER (ORDER BY brand) AS brand_id, brand FROM enriched
WHERE brand IS NOT NULL GROUP BY brand""")
block("comp_category", "enriched", """
SELECT row_number() OVER (ORDER BY category) AS category_id, category FROM enriched
WHERE category IS NOT NULL GROUP BY category""")

# Versions made from orders, some of them broken.

block("loose", "", """
SELECT o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS valid_from,
       CASE WHEN bool_or(o_orderstatus = 'F') THEN CAST(o_orderdate AS DATE) + 30 END AS valid_to,
       NOT bool_or(o_orderstatus = 'F') OR bool_or(o_orderpriority = '1-URGENT') AS is_current
FROM orders GROUP BY o_custkey, CAST(o_orderdate AS DATE)""")


# Checks. A line is (kind, table name, check name, severity, tags, SQL for the violations).


def _line(table: str, check: str, sql: str, severity: str = "error", tags: str = "") -> str:
    return (
        f"SELECT '{table}' AS table_name, '{check}' AS check_name, '{severity}' AS severity, "
        f"'{tags}' AS tags, CAST(({sql}) AS BIGINT) AS violations"
    )


def report(lines: list[str]) -> str:
    union = " UNION ALL ".join(lines)
    return (
        "SELECT *, CASE WHEN violations = 0 THEN 'pass' ELSE severity END AS status "
        f"FROM ({union})"
    )


class Lines:
    """Check lines over the SQL form of each table."""

    def __init__(self, tables: dict[str, str]):
        self.tables = tables
        self.lines: list[str] = []

    def _rows(self, table: str, check: str, bad: str, **kw) -> None:
        if table in self.tables:
            sql = f"SELECT count(*) FILTER ({bad}) FROM {self.tables[table]}"
            self.lines.append(_line(table, check, sql, **kw))

    def filled(self, table: str, *columns: str, **kw) -> None:
        for c in columns:
            self._rows(table, f"not_null_{c}", f"{c} IS NULL", **kw)

    def values(self, table: str, column: str, allowed, **kw) -> None:
        bad = f"{column} IS NOT NULL AND {column} NOT IN ({texts(allowed)})"
        self._rows(table, f"accepted_values_{column}", bad, **kw)

    def between(self, table: str, column: str, low: str, high: str | None = None, **kw) -> None:
        bad = f"{column} < {low}" + (f" OR {column} > {high}" if high else "")
        self._rows(table, f"accepted_range_{column}", bad, **kw)

    def dated(self, table: str, column: str) -> None:
        self.between(table, column, "DATE '2020-01-01'", BUILD_DAY)

    def clean(self, table: str, column: str, **kw) -> None:
        self._rows(table, f"injection_scan_{column}", injected(f"CAST({column} AS VARCHAR)"), **kw)

    def once(self, table: str, column: str, **kw) -> None:
        sql = (f"SELECT count(*) FROM (SELECT {column} FROM {self.tables[table]} "
               f"WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)")
        self.lines.append(_line(table, f"unique_{column}", sql, **kw))

    def together(self, table: str, *columns: str, **kw) -> None:
        names = ", ".join(columns)
        sql = (f"SELECT count(*) FROM (SELECT {names} FROM {self.tables[table]} "
               f"GROUP BY {names} HAVING count(*) > 1)")
        self.lines.append(_line(table, f"unique_combination_{'_'.join(columns)}", sql, **kw))

    def keyed(self, table: str, column: str, **kw) -> None:
        self.once(table, column, **kw)
        self.filled(table, column, **kw)

    def points(self, table: str, column: str, parent: str, parent_column: str, **kw) -> None:
        sql = (f"SELECT count(*) FROM {self.tables[table]} c WHERE c.{column} IS NOT NULL AND "
               f"NOT EXISTS (SELECT 1 FROM {self.tables[parent]} p "
               f"WHERE p.{parent_column} = c.{column})")
        check = f"relationship_{column}_to_{parent}_{parent_column}"
        self.lines.append(_line(table, check, sql, **kw))


def injected(text: str) -> str:
    hits = " OR ".join(
        f"regexp_matches({text}, '{p.replace(chr(39), chr(39) * 2)}')" for p in values.INJECTION_PATTERNS
    )
    return f"{text} IS NOT NULL AND trim({text}) <> '' AND ({hits})"


WARN = {"severity": "warn"}
CRITICAL = {"tags": "critical"}


def source_lines() -> list[str]:
    t = Lines({
        "adplatform_data": "e_ad_wide", "funnelevents": "e_funnel",
        "product_costs": "(SELECT product_id AS item_id, unit_cost AS cost_of_item FROM products)",
        "product_listprices":
            "(SELECT product_id AS item_id, list_price AS item_list_price FROM products)",
        "product_returns": "o_returns", "productattributes": "o_attributes",
        "sessions": "e_raw_sessions", "transactions": "o_transactions",
        "transactionsanditems": "(SELECT *, product_price AS item_price, "
                                "product_quantity AS item_quantity FROM o_items)",
        "users": "o_users",
    })
    t.together("adplatform_data", "date")
    t.filled("adplatform_data", "date")
    t.dated("adplatform_data", "date")
    for name in ("criteo", "google"):
        for metric in ("clicks", "cost", "impressions"):
            t.between("adplatform_data", f"{name}_{metric}", "0")
    t.filled("funnelevents", "date", "event_name", "event_time", "session_id")
    t.values("funnelevents", "device_category", values.DEVICES, **WARN)
    t.values("funnelevents", "event_name", values.EVENTS, **WARN)
    for table, column in (("product_costs", "cost_of_item"), ("product_listprices", "item_list_price")):
        t.together(table, "item_id")
        t.filled(table, column, "item_id")
        t.between(table, column, "0")
        t.once(table, "item_id")
    t.together("product_returns", "transaction_id", "item_id", **WARN)
    t.filled("product_returns", "return_date", "transaction_id", "item_id", "product_id")
    t.dated("product_returns", "return_date")
    t.between("product_returns", "return_quantity", "0")
    t.values("product_returns", "return_status", values.RETURN_STATUSES, **WARN)
    t.keyed("productattributes", "item_id")
    t.filled("sessions", "date", "session_id")
    t.dated("sessions", "date")
    t.values("sessions", "device_category", values.DEVICES, **WARN)
    t.values("sessions", "traffic_medium", values.TRAFFIC_MEDIUMS, **WARN)
    t.together("transactions", "transaction_id")
    t.filled("transactions", "transaction_id", "date", "session_id")
    t.once("transactions", "transaction_id")
    t.dated("transactions", "date")
    for column in ("revenue", "shipping", "total"):
        t.between("transactions", f"transaction_{column}", "0")
    t.filled("transactionsanditems", "item_id", "transaction_id", "product_id", "date")
    t.once("transactionsanditems", "item_id")
    t.dated("transactionsanditems", "date")
    t.between("transactionsanditems", "item_price", "0")
    t.between("transactionsanditems", "item_quantity", "1")
    t.together("users", "customer_id", "valid_from")
    t.filled("users", "customer_id", "valid_from")
    t.clean("users", "customer_id", **WARN)
    t.values("users", "user_gender", values.USER_GENDERS, **WARN)
    t.clean("users", "user_gender", **WARN)
    return t.lines


def listing_lines() -> list[str]:
    t = Lines({"competitor_listings": "enriched"})
    table = "competitor_listings"
    t.together(table, "id")
    t.once(table, "id")
    t.filled(table, "id", "title", "url", "transformation_timestamp")
    t.between(table, "price", "0")
    t.values(table, "currency", values.CURRENCIES, **WARN)
    t.values(table, "condition", values.LISTING_CONDITIONS, **WARN)
    t.values(table, "gender", values.LISTING_GENDERS, **WARN)
    return t.lines


PRODUCT_DIM = (
    f"(SELECT product_id, {key('product_id')} AS product_key, {key('brand')} AS brand_key, "
    f"{key('sub_category')} AS sub_category_key, {BUILD_DAY} AS valid_from, TRUE AS is_current "
    "FROM products)"
)
SUB_DIM = (
    f"(SELECT DISTINCT {key('sub_category')} AS sub_category_key, sub_category, "
    f"{key('main_category')} AS main_category_key FROM products)"
)
HOUSE = {
    "dim_date": "dim_date", "dim_users": "e_dim_users", "dim_products": PRODUCT_DIM,
    "dim_brand": f"(SELECT DISTINCT {key('brand')} AS brand_key, brand FROM products)",
    "dim_main_category":
        f"(SELECT DISTINCT {key('main_category')} AS main_category_key FROM products)",
    "dim_sub_category": SUB_DIM, "dim_source": "dim_source", "dim_medium": "dim_medium",
    "dim_geo": "dim_geo",
    "dim_region": f"(SELECT DISTINCT {key('region', 'country')} AS region_key, "
                  f"{key('country')} AS country_key FROM geo WHERE region IS NOT NULL)",
    "dim_country": f"(SELECT DISTINCT {key('country')} AS country_key FROM geo)",
    "dim_devices": "dim_device", "dim_ad_platform": "dim_ad", "fct_sessions": "fct_sessions",
    "fct_transactions": "e_fct_transactions", "fct_advertising": "fct_ad",
    "rpt_transactions": "e_rpt", "rpt_customer_activity": "e_activity",
    "rpt_daily_channel_performance": "channel",
}


def core_lines() -> list[str]:
    t = Lines(HOUSE)
    t.keyed("dim_date", "date_key")
    t.filled("dim_date", "date")
    t.keyed("dim_users", "user_key")
    t.filled("dim_users", "customer_id", "valid_from", "is_current")
    t.keyed("dim_products", "product_key")
    t.filled("dim_products", "product_id", "valid_from", "is_current")
    t.points("dim_products", "brand_key", "dim_brand", "brand_key")
    t.points("dim_products", "sub_category_key", "dim_sub_category", "sub_category_key")
    for table, column in (
        ("dim_brand", "brand_key"), ("dim_main_category", "main_category_key"),
        ("dim_sub_category", "sub_category_key"), ("dim_source", "source_key"),
        ("dim_medium", "medium_key"), ("dim_geo", "geo_key"), ("dim_region", "region_key"),
        ("dim_country", "country_key"), ("dim_devices", "device_key"),
        ("dim_ad_platform", "platform_key"),
    ):
        t.keyed(table, column)
    t.points("dim_sub_category", "main_category_key", "dim_main_category", "main_category_key")
    t.points("dim_geo", "region_key", "dim_region", "region_key")
    t.points("dim_region", "country_key", "dim_country", "country_key")
    t.once("fct_sessions", "session_id", **WARN)
    t.filled("fct_sessions", "session_id", "date_key")
    t.points("fct_sessions", "date_key", "dim_date", "date_key")
    t.points("fct_sessions", "customer_id", "dim_users", "customer_id", **WARN)
    t.points("fct_sessions", "source_key", "dim_source", "source_key", **WARN)
    t.points("fct_sessions", "platform_key", "dim_ad_platform", "platform_key")
    t.points("fct_sessions", "medium_key", "dim_medium", "medium_key", **WARN)
    t.points("fct_sessions", "geo_key", "dim_geo", "geo_key")
    t.points("fct_sessions", "device_key", "dim_devices", "device_key")
    t.keyed("fct_transactions", "item_id")
    t.filled("fct_transactions", "date_key")
    t.points("fct_transactions", "date_key", "dim_date", "date_key")
    t.points("fct_transactions", "customer_id", "dim_users", "customer_id", **WARN)
    t.points("fct_transactions", "session_id", "fct_sessions", "session_id", **WARN)
    t.points("fct_transactions", "product_id", "dim_products", "product_id")
    t.keyed("fct_advertising", "ad_key")
    t.filled("fct_advertising", "date_key")
    t.points("fct_advertising", "date_key", "dim_date", "date_key")
    t.points("fct_advertising", "platform_key", "dim_ad_platform", "platform_key")
    return t.lines


def critical_lines(tables: dict[str, str], t: Lines | None = None) -> list[str]:
    t = t or Lines(tables)
    t.keyed("rpt_transactions", "item_id", **CRITICAL)
    t.filled("rpt_transactions", "date_key", "product_id", **CRITICAL)
    t.points("rpt_transactions", "date_key", "dim_date", "date_key", **CRITICAL)
    t.points("rpt_transactions", "product_id", "dim_products", "product_id", **CRITICAL)
    return t.lines


def mart_lines() -> list[str]:
    t = Lines(HOUSE)
    critical_lines(HOUSE, t)
    t.points("rpt_transactions", "customer_id", "dim_users", "customer_id", **WARN)
    t.filled("rpt_transactions", "coupon_flag", "quantity", "revenue", "refund_amount", "net_revenue")
    t.filled(
        "rpt_customer_activity", "customer_id", "activity_type", "activity_date",
        "activity_timestamp", "customer_state_at_time", "customer_version_key", "change_type",
        "customer_activity_sequence", "customer_tenure_days",
    )
    t.values("rpt_customer_activity", "activity_type", values.ACTIVITY_TYPES)
    t.values("rpt_customer_activity", "customer_state_at_time", values.CUSTOMER_STATES)
    t.filled("rpt_daily_channel_performance", "date")
    return t.lines


def competitor_lines() -> list[str]:
    t = Lines({
        "competitor_dim_brand": "comp_brand", "competitor_dim_category": "comp_category",
        "competitor_fct_items": "(SELECT e.*, brand_id, category_id FROM enriched e "
                                "JOIN comp_brand USING (brand) JOIN comp_category USING (category))",
    })
    for table, columns in (
        ("competitor_dim_brand", ("brand_id", "brand")),
        ("competitor_dim_category", ("category_id", "category")),
        ("competitor_fct_items", ("id",)),
    ):
        for column in columns:
            t.keyed(table, column)
    t.filled("competitor_fct_items", "brand_id", "category_id")
    return t.lines


def gate_sql() -> str:
    tables = {
        "adplatform_data": "e_ad_wide", "funnelevents": "lineitem", "product_costs": "part",
        "product_listprices": "part", "product_returns": "o_returns", "productattributes": "part",
        "sessions": "events", "transactions": "orders", "transactionsanditems": "lineitem",
        "users": "o_users",
    }
    lines = [
        f"SELECT 'row_count' AS kind, '{n}' AS subject, (SELECT count(*) FROM {s}) AS amount"
        for n, s in tables.items()
    ]
    children = {
        "transactions": "(SELECT session_id FROM o_transactions)",
        "funnelevents": "(SELECT l_orderkey || '-' || CAST(l_shipdate AS DATE) AS session_id "
                        "FROM lineitem)",
    }
    for table, sql in children.items():
        lines.append(
            f"SELECT 'orphans', '{table}.session_id -> sessions.session_id', (SELECT count(*) "
            f"FROM {sql} c WHERE c.session_id NOT IN (SELECT session_id FROM e_events))"
        )
    for child, sql, column, parent, parent_sql, parent_column in (
        ("transactionsanditems", "o_items", "transaction_id", "transactions", "o_transactions",
         "transaction_id"),
        ("transactionsanditems", "o_items", "product_id", "productattributes",
         "(SELECT p_partkey AS item_id FROM part)", "item_id"),
        ("product_returns", "o_returns", "transaction_id", "transactions", "o_transactions",
         "transaction_id"),
        ("product_returns", "o_returns", "item_id", "transactionsanditems", "o_items", "item_id"),
    ):
        lines.append(
            f"SELECT 'orphans', '{child}.{column} -> {parent}.{parent_column}', (SELECT count(*) "
            f"FROM {sql} c WHERE NOT EXISTS (SELECT 1 FROM {parent_sql} p "
            f"WHERE p.{parent_column} = c.{column}))"
        )
    for name, sql, column, allowed in (
        ("users", "o_users", "user_gender", values.USER_GENDERS),
        ("sessions", "e_raw_sessions", "device_category", values.DEVICES),
        ("product_returns", "o_returns", "return_status", values.RETURN_STATUSES),
    ):
        lines.append(
            f"SELECT 'unexpected_values', '{name}.{column}', (SELECT count(*) FROM {sql} "
            f"WHERE {column} NOT IN ({texts(allowed)}))"
        )
    return " UNION ALL ".join(lines)


def invariants_sql() -> str:
    clicks = " OR ".join(f"{p}_clicks > {p}_impressions" for p in AD_PLATFORMS)
    ordered = (
        "(SELECT *, lag(valid_from) OVER w AS prev_from, "
        "lag((city, user_gender, opt_in_status, plus_status, plus_tier)) OVER w AS prev_state "
        "FROM o_users WINDOW w AS (PARTITION BY customer_id ORDER BY valid_from))"
    )
    lines = {
        "order revenue is the sum of its units":
            "SELECT count(*) FROM o_transactions t LEFT JOIN (SELECT transaction_id, "
            "sum(CAST(product_price * product_quantity AS DECIMAL(28,6))) AS s FROM o_items "
            "GROUP BY ALL) u ON u.transaction_id = t.transaction_id WHERE "
            "abs(CAST(transaction_revenue AS DECIMAL(28,6)) - coalesce(s, 0)) >= 0.01",
        "order total is revenue plus shipping":
            "SELECT count(*) FROM o_transactions WHERE "
            "abs(transaction_total - (transaction_revenue + transaction_shipping)) >= 0.01",
        "a unit row has quantity one":
            "SELECT count(*) FROM o_items WHERE product_quantity <> 1",
        "clicks do not exceed impressions": f"SELECT count(*) FROM e_ad_wide WHERE {clicks}",
        "list price covers cost": "SELECT count(*) FROM products WHERE list_price < unit_cost",
        "product gender is known":
            f"SELECT count(*) FROM products WHERE gender_target NOT IN ({texts(PRODUCT_GENDERS)})",
        "purchase events and only they name a transaction":
            "SELECT count(*) FROM lineitem WHERE l_orderkey IS NULL",
        "logged-in activity is on or after registration":
            "SELECT count(*) FROM e_raw_sessions s JOIN (SELECT customer_id, min(first_day) AS j "
            "FROM o_users GROUP BY ALL) u ON u.customer_id = s.customer_id WHERE s.date < u.j",
        "versions have different start days":
            f"SELECT count(*) FROM {ordered} WHERE prev_from = valid_from",
        "a version changes a tracked attribute":
            f"SELECT count(*) FROM {ordered} WHERE prev_from IS NOT NULL AND "
            "prev_state IS NOT DISTINCT FROM "
            "(city, user_gender, opt_in_status, plus_status, plus_tier)",
        "the oldest version starts at registration":
            f"SELECT count(*) FROM {ordered} WHERE prev_from IS NULL AND "
            "valid_from IS DISTINCT FROM first_day",
        "a tier is set exactly for members":
            "SELECT count(*) FROM o_users WHERE plus_status <> (plus_tier IS NOT NULL)",
    }
    return " UNION ALL ".join(
        f"SELECT '{name}' AS invariant, ({sql}) AS violations" for name, sql in lines.items()
    )


HOUSE_BLOCKS = (
    "dim_date e_dim_users products dim_source dim_medium dim_geo geo dim_device dim_ad "
    "fct_sessions e_fct_transactions fct_ad"
)

# query -> (blocks needed, SQL)
QUERIES: dict[str, tuple[str, str]] = {
    "stg_product_attributes": ("o_attributes", "SELECT * FROM o_attributes"),
    "stg_product_costs": (
        "products", "SELECT product_id, unit_cost AS product_cost FROM products"),
    "stg_product_list_prices": ("products", "SELECT product_id, list_price FROM products"),
    "stg_product_returns": ("o_returns", "SELECT * FROM o_returns"),
    "stg_transactions": (
        "o_transactions", "SELECT * EXCLUDE (raw_customer) FROM o_transactions"),
    "stg_transactions_and_items": ("o_items", "SELECT * FROM o_items"),
    "stg_users": ("o_stg_users", "SELECT * FROM o_stg_users"),
    "stg_ad_platform": ("e_ad_wide", "SELECT * FROM e_ad_wide"),
    "stg_ad_platform_unpivoted": ("e_ad", "SELECT * FROM e_ad"),
    "stg_funnel_events": ("e_funnel", "SELECT * FROM e_funnel"),
    "stg_sessions": ("e_stg_sessions", "SELECT * FROM e_stg_sessions"),
    "calendar_order_days": ("dim_date o_transactions", """
SELECT d.*, t.orders FROM dim_date d LEFT JOIN
  (SELECT date, count(*) AS orders FROM o_transactions GROUP BY date) t ON t.date = d.date"""),
    "dim_users": ("o_dim_users", "SELECT * FROM o_dim_users"),
    "dim_products": ("products", f"""
SELECT {key('product_id')} AS product_key, product_id, {key('brand')} AS brand_key,
       {key('main_category')} AS main_category_key,
       {key('sub_category')} AS sub_category_key, name, gender_target, list_price, unit_cost,
       CASE WHEN list_price > 0 THEN (list_price - unit_cost) / list_price ELSE 0 END
         AS profit_margin, {BUILD_DAY} AS valid_from, CAST(NULL AS DATE) AS valid_to,
       TRUE AS is_current
FROM products"""),
    "dim_brand": ("o_attributes", f"""
SELECT DISTINCT {key('item_brand')} AS brand_key, item_brand AS brand_name FROM o_attributes"""),
    "dim_main_category": ("o_attributes", f"""
SELECT DISTINCT {key('item_main_category')} AS main_category_key,
       item_main_category AS main_category_name FROM o_attributes"""),
    "dim_sub_category": ("o_attributes", f"""
SELECT DISTINCT {key('item_sub_category')} AS sub_category_key,
       item_sub_category AS sub_category_name, {key('item_main_category')} AS main_category_key
FROM o_attributes"""),
    "geo_locations": ("geo", "SELECT * FROM geo"),
    "dim_country": (
        "geo", f"SELECT DISTINCT {key('country')} AS country_key, country AS country_name FROM geo"),
    "dim_region": ("geo", f"""
SELECT DISTINCT {key('region', 'country')} AS region_key, region AS region_name,
       {key('country')} AS country_key FROM geo WHERE region IS NOT NULL"""),
    "dim_geo": ("dim_geo", "SELECT * FROM dim_geo"),
    "dim_source": ("dim_source", "SELECT * FROM dim_source"),
    "dim_medium": ("dim_medium", f"""
SELECT *, {grouped('lower(medium)', values.MEDIUM_CATEGORIES, "'Other'")} AS medium_category
FROM dim_medium"""),
    "dim_devices": ("dim_device", f"""
SELECT *, {grouped('lower(device_category)', values.DEVICE_TYPES, "'Other'")} AS device_type,
       'Unknown' AS browser, 'Unknown' AS os FROM dim_device"""),
    "dim_ad_platform": ("dim_ad", "SELECT * FROM dim_ad"),
    "ad_channels_custom": ("dim_ad", """
SELECT * REPLACE (CASE WHEN platform_name = 'google' THEN 'Search'
                       WHEN platform_name IN ('meta', 'tiktok') THEN 'Paid Social'
                       WHEN platform_name IN ('criteo', 'rtbhouse') THEN 'DSP'
                       ELSE 'Other' END AS channel_type) FROM dim_ad"""),
    "fct_advertising": ("fct_ad", "SELECT * FROM fct_ad"),
    "fct_sessions": ("fct_sessions", "SELECT * FROM fct_sessions"),
    "fct_transactions": ("o_fct_transactions", "SELECT * FROM o_fct_transactions"),
    "fct_transactions_web": ("e_fct_transactions", "SELECT * FROM e_fct_transactions"),
    "rpt_transactions": ("o_rpt", "SELECT * FROM o_rpt"),
    "rpt_transactions_web": ("e_rpt", "SELECT * FROM e_rpt"),
    "rpt_customer_activity": ("o_activity", "SELECT * FROM o_activity"),
    "rpt_customer_activity_as_of": ("o_activity_as_of", "SELECT * FROM o_activity_as_of"),
    "rpt_daily_channel_performance": ("channel", "SELECT * FROM channel"),
    "channel_performance_window": (
        "channel",
        "SELECT * FROM channel WHERE date BETWEEN DATE '2024-01-08' AND DATE '2024-01-21'"),
    "channel_performance_from": (
        "channel", "SELECT * FROM channel WHERE date >= DATE '2024-01-15'"),
    "daily_spend_metrics": ("fct_ad dim_ad dim_source sales visits", f"""
SELECT DISTINCT s.date_key, s.source, a.cost, a.clicks, a.impressions,
       round(s.daily_transaction_total, 2) AS daily_transaction_total,
       round({ratio('s.conversions', 'v.session_num')} * 100, 2) AS conversion_rate,
       round({ratio('s.daily_transaction_total', 'a.cost')} * 100, 2) AS roas
FROM fct_ad a JOIN dim_ad p ON p.platform_key = a.platform_key
JOIN dim_source d ON d.source = p.platform_name
JOIN visits v ON v.date_key = a.date_key AND v.source = p.platform_name
JOIN sales s ON s.date_key = a.date_key AND s.source = p.platform_name"""),
    "weekly_brand_sales": ("o_rpt", f"""
SELECT product_brand, CAST(year(transaction_date) AS INTEGER) AS year,
       {week('transaction_date')} AS week, {money('revenue')} AS total_weekly_sales
FROM o_rpt GROUP BY ALL"""),
    "weekly_ad_spend": ("e_ad", f"""
SELECT ad_platform, CAST(year(date) AS INTEGER) AS year, {week('date')} AS week,
       round({money('cost')}, 2) AS weekly_cost,
       {ratio('sum(clicks)', 'sum(impressions)')} AS weekly_ctr,
       {ratio(money('cost'), 'sum(clicks)')} AS weekly_cpc
FROM e_ad GROUP BY ALL"""),
    "weekly_signups": ("o_stg_users", f"""
SELECT city, CAST(year(registration_date) AS INTEGER) AS year, {week('registration_date')} AS week,
       count(DISTINCT customer_id) AS total_signups FROM o_stg_users GROUP BY ALL"""),
    "weekly_signups_per_version": ("o_stg_users", f"""
SELECT city, CAST(year(registration_date) AS INTEGER) AS year, {week('registration_date')} AS week,
       count(*) AS total_signups FROM o_stg_users GROUP BY ALL"""),
    "monthly_channel_performance": ("channel", f"""
SELECT CAST(date_trunc('month', date) AS DATE) AS month, channel, {money('ad_spend')} AS ad_spend,
       CAST(sum(sessions) AS BIGINT) AS sessions, CAST(sum(new_users) AS BIGINT) AS new_users,
       CAST(sum(transaction_count) AS BIGINT) AS transactions, {money('total_revenue')} AS revenue,
       {ratio('sum(transaction_count)', 'sum(sessions)')} AS conversion_rate,
       {ratio(money('total_revenue'), money('ad_spend'))} AS roas
FROM channel GROUP BY ALL"""),
    "category_profitability": ("o_rpt", f"""
SELECT CAST(date_trunc('month', transaction_date) AS DATE) AS month, product_main_category,
       count(DISTINCT item_id) AS units_sold, CAST(sum(quantity) AS BIGINT) AS quantity,
       {money('revenue')} AS revenue, {money('gross_profit')} AS gross_profit,
       {money('net_revenue')} AS net_revenue,
       {ratio(money('gross_profit'), money('revenue'))} AS gross_margin,
       count(return_status) AS returned_units, {ratio('count(return_status)', 'count(*)')}
         AS return_rate
FROM o_rpt GROUP BY ALL"""),
    "average_order_value": ("o_rpt", f"""
SELECT count(*) AS orders, count(DISTINCT customer_id) AS purchasing_customers,
       round({ratio('CAST(sum(v) AS DOUBLE)', 'count(v)')}, 2) AS avg_order_value,
       round(CAST(sum(v) AS DOUBLE), 2) AS total_revenue
FROM (SELECT transaction_id, customer_id, sum(CAST(revenue AS DECIMAL(28,6))) AS v
      FROM o_rpt GROUP BY ALL)"""),
    "activity_mix": ("o_activity", """
SELECT CAST(date_trunc('month', activity_date) AS DATE) AS month, activity_type,
       customer_state_at_time, count(*) AS events, count(DISTINCT customer_id) AS customers
FROM o_activity GROUP BY ALL"""),
    "top_customers": ("o_dim_users", """
SELECT customer_id, plus_status, plus_tier, lifetime_orders, lifetime_value
FROM o_dim_users WHERE is_current ORDER BY lifetime_value DESC, customer_id LIMIT 100"""),
    "session_engagement": ("fct_sessions dim_date", f"""
SELECT CAST(date_trunc('month', d.date) AS DATE) AS month, count(*) AS sessions,
       count(*) FILTER (bounce_flag) AS bounces,
       {ratio('count(*) FILTER (bounce_flag)', 'count(*)')} AS bounce_rate,
       round(avg(session_duration_seconds), 1) AS avg_duration_seconds,
       CAST(sum(page_views) AS BIGINT) AS page_views,
       count(*) FILTER (transaction_count > 0) AS converting_sessions,
       {ratio('count(*) FILTER (transaction_count > 0)', 'count(*)')} AS session_conversion_rate
FROM fct_sessions f JOIN dim_date d ON d.date_key = f.date_key GROUP BY ALL"""),
    "conformed_keys": ("", f"""
SELECT p_partkey, {key('p_brand')} AS brand_key, {key('p_type', 'p_name')} AS pair_key,
       {key('p_brand', 'CASE WHEN p_size > 25 THEN p_type END')} AS null_key FROM part"""),
    "change_signatures": ("o_dim_users", """
SELECT user_key, md5(concat_ws('|', coalesce(city, '_null_'), coalesce(gender, '_null_'),
       coalesce(CAST(opt_in_status AS VARCHAR), '_null_'),
       coalesce(CAST(plus_status AS VARCHAR), '_null_'), coalesce(plus_tier, '_null_')))
         AS change_signature
FROM o_dim_users"""),
    "date_functions": ("", f"""
SELECT o_orderkey, {day_key('o_orderdate')} AS day_key, CAST(o_orderdate AS DATE) AS day_from_key,
       {week('o_orderdate')} AS week, CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS weekday,
       CAST(quarter(o_orderdate) AS INTEGER) AS quarter, dayofweek(o_orderdate) IN (0, 6) AS weekend,
       strftime(o_orderdate, '%m%d') IN ('1225', '0101', '0704') AS holiday,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
       CAST(o_orderdate AS DATE) + INTERVAL 12 HOURS AS noon
FROM orders"""),
    "event_times": ("", """
SELECT user_id, date_sub('second', min(ts), max(ts)) AS seconds,
       strftime(min(ts), '%H:%M:%S') AS first_time,
       CAST(CAST(max(ts) AS DATE) - CAST(min(ts) AS DATE) AS INTEGER) AS days
FROM events GROUP BY user_id"""),
    "safe_casts": ("o_transactions", f"""
SELECT CAST(transaction_id AS VARCHAR) AS transaction_id, customer_id AS digits_only,
       CAST(NULL AS BIGINT) AS not_a_number,
       {ratio('transaction_total', 'transaction_id % 3')} AS by_zero,
       round({ratio('transaction_revenue', 'transaction_total')} * 100, 2) AS share
FROM o_transactions"""),
    "text_functions": ("", f"""
SELECT p_partkey, {title("replace(p_name, ' ', '-') || '''' || lower(p_brand)")} AS title,
       {capitals("p_name || '  ' || lower(p_type)")} AS words, p_name AS second,
       CAST(NULL AS VARCHAR) AS absent
FROM part"""),
    "source_names": ("e_raw_sessions", f"""
SELECT traffic_source, count(*) AS session_rows,
       {grouped('lower(trim(traffic_source))', values.TRAFFIC_SOURCES, 'traffic_source')} AS source
FROM e_raw_sessions GROUP BY traffic_source"""),
    "agent_rules": ("", f"""
SELECT page_id, {by_substring('agent', values.BROWSERS, "coalesce(agent, 'Unknown')")} AS browser,
       {by_substring('agent', values.OPERATING_SYSTEMS, "coalesce(agent, 'Unknown')")} AS os
FROM (SELECT page_id, CASE WHEN page_id % 53 > 0 THEN
        {pick(values.AGENT_BROWSERS, 'page_id')} || ' ' ||
        {pick(values.AGENT_SYSTEMS, 'page_id // 7')} END AS agent
      FROM pages)"""),
    "unit_explosion": ("o_items", f"""
SELECT {key('item_id', 'unit_no')} AS unit_id, CAST(transaction_id AS VARCHAR) AS transaction_id,
       CAST(product_id AS VARCHAR) AS product_id, unit_no, product_price AS item_price,
       CAST(1 AS BIGINT) AS item_quantity
FROM (SELECT *, unnest(generate_series(1, product_quantity)) AS unit_no FROM o_items)"""),
    "session_measures": ("measures", "SELECT * FROM measures"),
    "session_page_view_kinds": ("e_funnel", """
SELECT *, page_views = 1 AND add_to_cart_flag = 0 AND transaction_count = 0 AS bounce_flag
FROM (SELECT session_id, count(*) AS events,
             count(DISTINCT CASE WHEN event_name = 'page_view' THEN 1 ELSE 0 END) AS page_views,
             max(CASE WHEN event_name = 'add_to_cart' THEN 1 ELSE 0 END) AS add_to_cart_flag,
             count(*) FILTER (event_name = 'purchase') AS transaction_count,
             date_sub('second', min(event_time), max(event_time)) AS session_duration
      FROM e_funnel GROUP BY session_id)"""),
    "customer_totals": ("o_totals", "SELECT * FROM o_totals"),
    "as_of_left_join": ("o_items o_transactions o_dim_users", """
SELECT i.item_id, i.transaction_id, i.date, t.customer_id, u.plus_tier, u.city
FROM o_items i LEFT JOIN o_transactions t ON t.transaction_id = i.transaction_id
LEFT JOIN o_dim_users u ON u.customer_id = t.customer_id AND i.date >= u.valid_from
     AND (u.valid_to IS NULL OR i.date < u.valid_to)"""),
    "as_of_inner_join": ("o_items o_transactions o_dim_users", """
SELECT i.item_id, i.transaction_id, i.date, t.customer_id, u.plus_tier, u.city
FROM o_items i JOIN o_transactions t ON t.transaction_id = i.transaction_id
JOIN o_dim_users u ON u.customer_id = t.customer_id AND i.date >= u.valid_from
     AND (u.valid_to IS NULL OR i.date < u.valid_to)"""),
    "current_version_join": ("o_transactions o_dim_users", """
SELECT t.transaction_id, t.customer_id, u.city, u.plus_status, u.lifetime_orders
FROM o_transactions t
LEFT JOIN o_dim_users u ON u.customer_id = t.customer_id AND u.is_current"""),
    "scd2_snapshot": ("", """
WITH days AS (
    SELECT o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS day,
           arg_max(o_orderpriority, o_orderkey) AS tier
    FROM orders GROUP BY ALL),
history AS (
    SELECT customer_id, tier, day AS valid_from,
           lead(day) OVER (PARTITION BY customer_id ORDER BY day) AS valid_to
    FROM days WHERE day < DATE '1998-01-01'),
snapshot AS (
    SELECT customer_id, arg_max(tier, day) AS tier FROM days
    WHERE day >= DATE '1998-01-01' GROUP BY customer_id),
open_rows AS (SELECT * FROM history WHERE valid_to IS NULL)
SELECT customer_id, tier, valid_from, valid_to, FALSE AS is_current
FROM history WHERE valid_to IS NOT NULL
UNION ALL
SELECT o.customer_id, o.tier, o.valid_from,
       CASE WHEN s.tier IS DISTINCT FROM o.tier THEN DATE '2002-01-01' END,
       s.tier IS NOT DISTINCT FROM o.tier
FROM open_rows o LEFT JOIN snapshot s ON s.customer_id = o.customer_id
UNION ALL
SELECT s.customer_id, s.tier, DATE '2002-01-01', NULL, TRUE
FROM snapshot s LEFT JOIN open_rows o ON o.customer_id = s.customer_id
WHERE o.customer_id IS NULL OR o.tier <> s.tier"""),
    "lifetime_as_of": ("o_dim_users_as_of", """
SELECT customer_id, valid_from, lifetime_orders, lifetime_value FROM o_dim_users_as_of"""),
    "profile_changes": ("o_changes", "SELECT * FROM o_changes"),
    "event_sequence": ("", """
SELECT event_id, user_id, CAST(ts AS DATE) AS day,
       row_number() OVER w AS sequence, lag(CAST(ts AS DATE)) OVER w AS prev_day,
       min(CAST(ts AS DATE)) OVER (PARTITION BY user_id) AS first_day
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY CAST(ts AS DATE), event_id)"""),
    "profile_change_counts": ("o_changes", """
SELECT customer_id, activity_date, change_type,
       CAST(count(*) OVER (PARTITION BY customer_id ORDER BY activity_date) AS BIGINT)
         AS sequence_check
FROM o_changes"""),
    "ordered_ad_numbers": ("e_ad", """
SELECT row_number() OVER (ORDER BY date, ad_platform) AS position, date, ad_platform, clicks, cost
FROM e_ad"""),
    "dense_keys": ("", """
SELECT row_number() OVER (ORDER BY p_type, p_name) AS name_no, p_type, p_name
FROM (SELECT DISTINCT p_type, p_name FROM part)"""),
    "purchase_times": ("o_times", "SELECT * FROM o_times"),
    "returns_per_item": (
        "o_returns", "SELECT item_id, return_status, return_date, return_quantity FROM o_returns"),
    "daily_sales_by_source": ("sales", "SELECT * FROM sales"),
    "daily_sessions_by_source": ("visits", "SELECT * FROM visits"),
    "best_sellers": ("best", "SELECT * FROM best"),
    "search_terms": ("best", """
SELECT rank, gender, lower('new ' || brand || ' ' || category || ' ' || gender) AS search_term
FROM (SELECT *, unnest(['mens', 'womens', 'unisex']) AS gender FROM best)"""),
    "competitor_listings": ("enriched", "SELECT * FROM enriched"),
    "competitor_dim_brand": ("comp_brand", "SELECT * FROM comp_brand"),
    "competitor_dim_category": ("comp_category", "SELECT * FROM comp_category"),
    "competitor_fct_items": ("enriched comp_brand comp_category", """
SELECT e.* EXCLUDE (brand, category), b.brand_id, c.category_id
FROM enriched e JOIN comp_brand b ON b.brand = e.brand
JOIN comp_category c ON c.category = e.category"""),
    "listing_flatten": ("raw_listings", f"""
SELECT CAST({key('url', 'search_term')} AS VARCHAR) AS id, search_term, title, price, currency,
       CAST(NULL AS VARCHAR) AS category, CAST(NULL AS VARCHAR) AS brand, condition, url
FROM raw_listings"""),
    "listing_csv_round_trip": ("raw_listings", """
SELECT id, search_term, 'a "b", ' || title || chr(10) || 'c' AS title, price, currency
FROM raw_listings"""),
    "listing_json_round_trip": ("raw_listings", f"""
SELECT CAST({key('url', 'search_term')} AS VARCHAR) AS id, search_term, title, price, currency,
       CAST(NULL AS VARCHAR) AS category, CAST(NULL AS VARCHAR) AS brand, condition, url
FROM raw_listings"""),
    "landing_round_trip": ("enriched", """
SELECT kind, currency, gender, count(*) AS rows, count(DISTINCT id) AS ids, max(title) AS last_title
FROM enriched, (SELECT unnest(['parquet', 'csv', 'landing']) AS kind) GROUP BY ALL"""),
    "stored_schema_drift": ("", """
SELECT table_name, column_name, data_type, test_result, (SELECT count(*) FROM part) AS row_count
FROM (VALUES ('product_costs', 'item_id', 'string', 'all_okay'),
             ('product_costs', 'cost_of_item', 'float', 'wrong_dt'),
             ('product_listprices', 'item_id', 'string', 'no_dt'),
             ('product_listprices', 'item_list_price', 'double', 'all_okay'),
             ('product_listprices', 'note', 'string', 'column_missing'),
             ('unknown_prices', 'item_id', 'string', 'table_missing'),
             ('unknown_prices', 'item_list_price', 'double', 'table_missing'))
  AS t(table_name, column_name, data_type, test_result)"""),
    "catalog_read_back": ("enriched", """
SELECT 'core' AS layer, 'dim_brand' AS object_name, 'EXTERNAL' AS kind,
       'Rows of dim_brand' AS comment, 'Key of dim_brand' AS key_comment,
       count(DISTINCT p_brand) AS row_count FROM part
UNION ALL SELECT 'marts', 'dim_products', 'EXTERNAL', 'Rows of dim_products',
       'Key of dim_products', count(*) FROM part
UNION ALL SELECT 'staging', 'stg_product_attributes', 'TEMPORARY', NULL, NULL, count(*) FROM part
UNION ALL SELECT 'landing', 'competitor_listings', 'EXTERNAL', NULL, NULL, count(*) FROM enriched"""),
    "sources_round_trip": ("o_users o_items o_returns", """
SELECT unnest(['productattributes', 'product_costs', 'product_listprices']) AS table_name,
       count(*) AS row_count, count(DISTINCT p_partkey) AS distinct_keys FROM part
UNION ALL SELECT 'users', count(*), count(DISTINCT customer_id) FROM o_users
UNION ALL SELECT 'transactions', count(*), count(DISTINCT o_orderkey) FROM orders
UNION ALL SELECT 'transactionsanditems', count(*), count(DISTINCT item_id) FROM o_items
UNION ALL SELECT 'product_returns', count(*), count(DISTINCT item_id) FROM o_returns"""),
    "listing_foreign_currency": (
        "raw_listings",
        "SELECT id, currency, currency IS DISTINCT FROM 'GBP' AS is_foreign_currency "
        "FROM raw_listings"),
    "listing_attributes": ("parsed", "SELECT id, brand, category, gender FROM parsed"),
    "check_source_rules": (
        "e_ad_wide e_funnel products o_returns o_attributes e_raw_sessions o_transactions o_items "
        "o_users", report(source_lines())),
    "check_listing_rules": ("enriched", report(listing_lines())),
    "check_core_rules": (HOUSE_BLOCKS, report(core_lines())),
    "check_mart_rules": (f"{HOUSE_BLOCKS} e_rpt e_activity channel", report(mart_lines())),
    "check_critical_rules": (
        "o_rpt dim_date products", report(critical_lines({**HOUSE, "rpt_transactions": "o_rpt"}))),
    "check_competitor_rules": (
        "enriched comp_brand comp_category", report(competitor_lines())),
    "check_null_rows": ("o_transactions", """
SELECT transaction_id, date, transaction_total FROM o_transactions WHERE customer_id IS NULL"""),
    "check_duplicate_lines": ("", """
SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""),
    "check_duplicate_days": ("", """
SELECT o_custkey, o_orderdate, count(*) AS row_count FROM orders
GROUP BY o_custkey, o_orderdate HAVING count(*) > 1"""),
    "check_orphan_sessions": ("o_transactions e_stg_sessions", """
SELECT session_id AS key, count(*) AS child_rows FROM o_transactions
WHERE session_id NOT IN (SELECT session_id FROM e_stg_sessions) GROUP BY session_id"""),
    "check_accepted_values": ("e_raw_sessions", """
SELECT traffic_medium, count(*) AS bad_rows FROM e_raw_sessions
WHERE traffic_medium NOT IN ('organic', 'paid', 'email') GROUP BY traffic_medium"""),
    "check_numeric_range": ("", """
SELECT p_partkey, p_size FROM part WHERE (p_size < 5 OR p_size > 45) AND p_type <> 'PROMO'"""),
    "check_text_pattern": ("", """
SELECT p_partkey, p_name FROM part WHERE NOT regexp_matches(p_name, '^(red|blue|old) [a-z]+$')"""),
    "check_injection": ("", f"SELECT doc_id FROM documents WHERE {injected('text')}"),
    "source_freshness": ("", """
SELECT round(hours, 3) AS age_hours,
       CASE WHEN hours > 48 THEN 'error' WHEN hours > 24 THEN 'warn' ELSE 'pass' END AS status
FROM (SELECT date_sub('second', max(ts), TIMESTAMP '2024-02-01 12:00:00') / 3600.0::DOUBLE AS hours
      FROM events)"""),
    "null_comparison": ("o_transactions", " UNION ALL ".join(f"""
SELECT '{c}' AS column_name, count(*) AS source_total_records,
       count(*) - count({raw}) AS source_null_records,
       round({ratio(f'(count(*) - count({raw})) * 100', 'count(*)')}, 2) AS source_null_percentage,
       count(DISTINCT {raw}) AS source_unique_values, count(*) AS staged_total_records,
       count(*) - count({c}) AS staged_null_records,
       round({ratio(f'(count(*) - count({c})) * 100', 'count(*)')}, 2) AS staged_null_percentage,
       count(DISTINCT {c}) AS staged_unique_values, count({raw}) - count({c}) AS null_difference,
       CASE WHEN count({raw}) > count({c}) THEN 'more nulls'
            WHEN count({raw}) < count({c}) THEN 'fewer nulls' ELSE 'equal' END AS verdict
FROM o_transactions""" for c, raw in (
        ("customer_id", "raw_customer"), ("session_id", "session_id"),
        ("transaction_coupon", "transaction_coupon")))),
    "table_profile": ("o_transactions", f"""
SELECT *, CAST((null_users > 0)::INT + (null_keys > 0)::INT + (null_amounts > 0)::INT
          + (non_positive_amounts > 0)::INT + (future_days > 0)::INT AS INTEGER) AS issue_kinds
FROM (SELECT count(*) AS total_records, count(DISTINCT customer_id) AS unique_users,
             count(DISTINCT transaction_id) AS unique_keys, min(date) AS earliest_day,
             max(date) AS latest_day, count(DISTINCT date) AS distinct_days,
             {money('transaction_total')} AS total_amount,
             {ratio(money('transaction_total'), 'count(transaction_total)')} AS avg_amount,
             min(transaction_total) AS min_amount, max(transaction_total) AS max_amount,
             count(*) - count(customer_id) AS null_users,
             count(*) - count(transaction_id) AS null_keys,
             count(*) - count(transaction_total) AS null_amounts,
             count(*) FILTER (transaction_total <= 0) AS non_positive_amounts,
             count(*) FILTER (date > DATE '2001-01-01') AS future_days
      FROM o_transactions)"""),
    "product_updates": ("", f"""
SELECT p_partkey AS product_id, greatest(
    CASE WHEN p_partkey % 11 > 0 THEN {BUILD_DAY} + CAST(p_partkey % 5 AS INTEGER) END,
    CASE WHEN p_partkey % 11 > 0 AND p_partkey % 2 = 0
         THEN {BUILD_DAY} + CAST(p_partkey % 7 AS INTEGER) END,
    CASE WHEN p_partkey % 11 > 0 AND p_partkey % 3 > 0
         THEN {BUILD_DAY} + CAST(p_partkey % 13 AS INTEGER) END) AS updated_on
FROM part"""),
    "staged_validation": ("o_transactions", """
WITH counts AS (
    SELECT count(*) AS total_records, count(DISTINCT customer_id) AS unique_users,
           count(DISTINCT transaction_id) AS unique_keys,
           count(*) - count(customer_id) AS null_users,
           count(*) - count(transaction_id) AS null_keys,
           count(*) - count(transaction_total) AS null_amounts,
           count(*) FILTER (transaction_total <= 0) AS non_positive_amounts
    FROM o_transactions),
related AS (
    SELECT count(*) AS total_parent_records, count(DISTINCT transaction_id) AS unique_parent_keys,
           count(*) - count(transaction_id) AS null_parent_keys, count(*) AS total_child_records,
           count(DISTINCT transaction_id) AS unique_child_keys,
           count(*) - count(transaction_id) AS null_child_keys,
           CAST(0 AS BIGINT) AS orphaned_records
    FROM o_transactions)
SELECT 'profile' AS step, name AS subject, value AS number
FROM (UNPIVOT counts ON COLUMNS(*) INTO NAME name VALUE value)
UNION ALL SELECT 'relationship', name, value
FROM (UNPIVOT related ON COLUMNS(*) INTO NAME name VALUE value)
UNION ALL SELECT 'null_comparison', 'customer_id', count(raw_customer) - count(customer_id)
FROM o_transactions
UNION ALL SELECT 'columns', unnest([
    'date', 'user_cookie_id', 'customer_id', 'session_id', 'transaction_id', 'transaction_coupon',
    'transaction_revenue', 'transaction_shipping', 'transaction_total']), CAST(1 AS BIGINT)"""),
    "relationship_counts": ("", """
SELECT (SELECT count(*) FROM orders) AS total_parent_records,
       (SELECT count(DISTINCT o_custkey) FROM orders) AS unique_parent_keys,
       (SELECT count(*) - count(o_custkey) FROM orders) AS null_parent_keys,
       (SELECT count(*) FROM customer) AS total_child_records,
       (SELECT count(DISTINCT c_custkey) FROM customer) AS unique_child_keys,
       (SELECT count(*) - count(c_custkey) FROM customer) AS null_child_keys,
       (SELECT count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders))
         AS orphaned_records"""),
    "row_counts": ("o_dim_users dim_date", """
SELECT 'stg_transactions' AS table_name, count(*) AS row_count FROM orders
UNION ALL SELECT 'fct_transactions', count(*) FROM lineitem
UNION ALL SELECT 'dim_users', count(*) FROM o_dim_users
UNION ALL SELECT 'dim_products', count(*) FROM part
UNION ALL SELECT 'dim_date', count(*) FROM dim_date
UNION ALL SELECT 'rpt_transactions', count(*) FROM lineitem"""),
    "missing_activity_types": ("e_activity", """
SELECT count(DISTINCT activity_type) AS n_types FROM e_activity
HAVING count(DISTINCT activity_type) < 2"""),
    "check_scd_integrity": ("loose", """
WITH k AS (SELECT CAST(customer_id AS VARCHAR) AS natural_key,
                  count(*) FILTER (is_current) AS n,
                  count(*) FILTER (is_current AND valid_to IS NOT NULL) AS ended,
                  count(*) FILTER (NOT is_current AND valid_to IS NULL) AS dangling
           FROM loose GROUP BY customer_id)
SELECT 'loose_versions' AS table_name, 'current_record_uniqueness' AS test_name, natural_key,
       n AS bad_rows FROM k WHERE n > 1
UNION ALL SELECT 'loose_versions', 'current_valid_to_null', natural_key, ended FROM k WHERE ended > 0
UNION ALL SELECT 'loose_versions', 'historical_valid_to_not_null', natural_key, dangling
FROM k WHERE dangling > 0"""),
    "check_scd_timeline": ("loose", """
SELECT CAST(customer_id AS VARCHAR) AS natural_key,
       CASE WHEN count(*) FILTER (is_current) = 0 THEN 'NO_CURRENT_RECORD'
            ELSE 'MULTIPLE_CURRENT_RECORDS' END AS issue_type,
       count(*) FILTER (is_current) AS issue_count
FROM loose GROUP BY customer_id HAVING count(*) FILTER (is_current) <> 1
UNION ALL
SELECT CAST(customer_id AS VARCHAR), issue, 1
FROM (SELECT customer_id, CASE
        WHEN lag(valid_to) OVER w <> valid_from THEN 'TEMPORAL_GAP_OR_OVERLAP'
        WHEN is_current AND valid_to IS NOT NULL THEN 'CURRENT_RECORD_HAS_END_DATE'
        WHEN NOT is_current AND valid_to IS NULL THEN 'HISTORICAL_RECORD_MISSING_END_DATE'
      END AS issue FROM loose WINDOW w AS (PARTITION BY customer_id ORDER BY valid_from))
WHERE issue IS NOT NULL"""),
    "check_users_timeline": ("o_dim_users", """
SELECT CAST(customer_id AS VARCHAR) AS natural_key, 'NO_CURRENT_RECORD' AS issue_type,
       count(*) FILTER (is_current) AS issue_count
FROM o_dim_users GROUP BY customer_id HAVING count(*) FILTER (is_current) <> 1"""),
    "check_users_timeline_gaps": ("o_dim_users", """
WITH kept AS (SELECT * FROM o_dim_users
              WHERE NOT (customer_id % 5 = 0 AND NOT is_current AND month(valid_from) % 2 = 1)
                AND NOT (customer_id % 7 = 0 AND is_current))
SELECT CAST(customer_id AS VARCHAR) AS natural_key, 'NO_CURRENT_RECORD' AS issue_type,
       CAST(0 AS BIGINT) AS issue_count
FROM kept GROUP BY customer_id HAVING NOT bool_or(is_current)
UNION ALL
SELECT CAST(customer_id AS VARCHAR), 'TEMPORAL_GAP_OR_OVERLAP', 1
FROM (SELECT customer_id, valid_from, lag(valid_to) OVER (PARTITION BY customer_id ORDER BY valid_from) AS ended
      FROM kept)
WHERE ended <> valid_from"""),
    "check_activity_timeline": ("o_activity o_dim_users", """
WITH a AS (SELECT customer_id, activity_type, activity_date - 7 AS day, customer_version_key,
                  customer_activity_sequence AS place
           FROM o_activity
           WHERE NOT (customer_activity_sequence = 1 AND customer_id % 3 = 0))
SELECT CAST(a.customer_id AS VARCHAR) AS customer_id, CAST(a.day AS VARCHAR) AS activity_date,
       CAST(a.customer_version_key AS VARCHAR) AS customer_version_key,
       'INVALID_SCD_JOIN' AS failure_reason
FROM a JOIN o_dim_users u ON u.user_key = a.customer_version_key
WHERE a.activity_type = 'transaction'
  AND NOT (a.day >= u.valid_from AND (u.valid_to IS NULL OR a.day < u.valid_to))
UNION ALL
SELECT CAST(customer_id AS VARCHAR), 'N/A', 'N/A', 'INVALID_CUSTOMER_SEQUENCE'
FROM a GROUP BY customer_id HAVING count(*) > 1 AND max(place) <> count(*)"""),
    "source_gate": ("e_ad_wide e_events e_raw_sessions o_returns o_users o_transactions o_items",
                    gate_sql()),
    "source_invariants": ("o_transactions o_items e_ad_wide products e_raw_sessions o_users",
                          invariants_sql()),
}


def _needed(names: str, seen: list[str]) -> list[str]:
    for name in names.split():
        if name not in seen:
            _needed(BLOCKS[name][0], seen)
            seen.append(name)
    return seen


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, (needs, sql) in QUERIES.items():
        ctes = ",\n".join(f"{b} AS ({BLOCKS[b][1].strip()})" for b in _needed(needs, []))
        out[name] = f"WITH {ctes}\nSELECT * FROM ({sql.strip()})" if ctes else sql.strip()
    return out
