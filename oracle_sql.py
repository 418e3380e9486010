"""Independent DuckDB SQL for every registered query (the correctness
oracle). Only the landing fixtures (the derivation of the retail tables
from the driver's tables) and fixed constants are shared with the Spark
side; every cleaning, dedup, join, aggregation and report step is
re-stated here in plain SQL.

Spark semantics that DuckDB does not share are spelled out:
* int through double truncates: TRY_CAST(trunc(TRY_CAST(x AS DOUBLE)) AS INTEGER);
* rounding is half-up on the decimal form: ROUND(CAST(x AS DECIMAL(38,9)), d);
* ascending order puts NULLs first (Spark's default);
* COUNT(DISTINCT a, b) skips tuples with a NULL part;
* dayofweek is 1 = Sunday .. 7 = Saturday;
* percentile_approx at accuracy 1e6 equals quantile_disc.
"""

from __future__ import annotations

from strata.sources.landing import LANDING_SQL, state_region_map, translation_rows

D = "CAST(100 AS DOUBLE)"


def CL(x):
    return f"NULLIF(trim({x}), '')"


def LW(x):
    return f"lower({CL(x)})"


def UP(x):
    return f"upper({CL(x)})"


def TI(x):
    return f"TRY_CAST(trunc(TRY_CAST({x} AS DOUBLE)) AS INTEGER)"


def TS(x):
    return f"TRY_CAST({x} AS TIMESTAMP)"


def TD(x):
    return f"TRY_CAST({x} AS DECIMAL(12,2))"


def DBL(x):
    return f"TRY_CAST({x} AS DOUBLE)"


def RHU(x, d):
    return f"CAST(ROUND(TRY_CAST({x} AS DECIMAL(38,9)), {d}) AS DOUBLE)"


def PCT(cond, d):
    return RHU(f"{D} * AVG(CASE WHEN {cond} THEN 1 ELSE 0 END)", d)


def DKEY(x):
    return f"CAST(strftime({x}, '%Y%m%d') AS INTEGER)"


def DAYS(end, start):
    return f"CAST(date_diff('day', CAST({start} AS DATE), CAST({end} AS DATE)) AS INTEGER)"


def region_case(x):
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in state_region_map().items())
    return f"CASE {x} {whens} END"


def dedup(src, cols, keys, order=()):
    rest = [f"{c} ASC NULLS FIRST" for c in sorted(cols) if c not in keys]
    order_by = ", ".join(list(order) + rest)
    return (f"SELECT {', '.join(cols)} FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} "
            f"ORDER BY {order_by}) AS rn__ FROM ({src}) t__) q__ WHERE rn__ = 1")


# ---------------------------------------------------------------- landing

_LANDING_NAMES = {
    "customers": "b_customers", "sellers": "b_sellers", "orders": "b_orders", "order_items": "b_items",
    "order_payments": "b_payments", "order_reviews": "b_reviews", "products": "b_products",
    "geolocation": "b_geolocation",
}
_TABLE_ARGS = {t: t for t in ("customer", "nation", "supplier", "orders", "lineitem", "part")}

CTES: dict[str, str] = {}
for _name, _view in _LANDING_NAMES.items():
    CTES[_view] = LANDING_SQL[_name].format(**_TABLE_ARGS).replace("AS STRING)", "AS VARCHAR)")
_vals = ", ".join("('" + a.replace("'", "''") + "', '" + b.replace("'", "''") + "')" for a, b in translation_rows())
CTES["b_translation"] = (f"SELECT * FROM (VALUES {_vals}) v(product_category_name, "
                         f"product_category_name_english)")

LANDING_COLUMNS = {
    "b_customers": ["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city",
                    "customer_state"],
    "b_sellers": ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"],
    "b_orders": ["order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
                 "order_delivered_carrier_date", "order_delivered_customer_date",
                 "order_estimated_delivery_date"],
    "b_items": ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price",
                "freight_value"],
    "b_payments": ["order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"],
    "b_reviews": ["review_id", "order_id", "review_score", "review_comment_message", "review_creation_date",
                  "review_answer_timestamp"],
    "b_products": ["product_id", "product_category_name", "product_name_lenght", "product_description_lenght",
                   "product_photos_qty", "product_weight_g", "product_length_cm", "product_height_cm",
                   "product_width_cm"],
    "b_geolocation": ["geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng", "geolocation_city",
                      "geolocation_state"],
    "b_translation": ["product_category_name", "product_category_name_english"],
}

# ---------------------------------------------------------------- silver

CTES["s_customers"] = dedup(
    f"SELECT {CL('customer_id')} AS customer_id, {CL('customer_unique_id')} AS customer_unique_id, "
    f"lpad({CL('customer_zip_code_prefix')}, 5, '0') AS customer_zip_code_prefix, "
    f"{LW('customer_city')} AS customer_city, {UP('customer_state')} AS customer_state "
    f"FROM b_customers WHERE {CL('customer_id')} IS NOT NULL",
    ["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"],
    ["customer_id"])

CTES["s_sellers"] = dedup(
    f"SELECT {CL('seller_id')} AS seller_id, lpad({CL('seller_zip_code_prefix')}, 5, '0') AS seller_zip_code_prefix, "
    f"{LW('seller_city')} AS seller_city, {UP('seller_state')} AS seller_state "
    f"FROM b_sellers WHERE {CL('seller_id')} IS NOT NULL",
    ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"], ["seller_id"])

_ORDER_COLS = ["order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
               "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date"]
CTES["s_orders"] = (
    "SELECT order_id, customer_id, order_status, order_purchase_timestamp, order_approved_at, "
    "order_delivered_carrier_date, "
    "CASE WHEN order_delivered_customer_date < order_purchase_timestamp THEN NULL "
    "ELSE order_delivered_customer_date END AS order_delivered_customer_date, order_estimated_delivery_date FROM ("
    + dedup(
        f"SELECT {CL('order_id')} AS order_id, {CL('customer_id')} AS customer_id, "
        f"{LW('order_status')} AS order_status, {TS('order_purchase_timestamp')} AS order_purchase_timestamp, "
        f"{TS('order_approved_at')} AS order_approved_at, "
        f"{TS('order_delivered_carrier_date')} AS order_delivered_carrier_date, "
        f"{TS('order_delivered_customer_date')} AS order_delivered_customer_date, "
        f"{TS('order_estimated_delivery_date')} AS order_estimated_delivery_date "
        f"FROM b_orders WHERE {CL('order_id')} IS NOT NULL", _ORDER_COLS, ["order_id"])
    + ") o__")

CTES["s_items"] = dedup(
    f"SELECT {CL('order_id')} AS order_id, {TI('order_item_id')} AS order_item_id, "
    f"{CL('product_id')} AS product_id, {CL('seller_id')} AS seller_id, "
    f"{TS('shipping_limit_date')} AS shipping_limit_date, {TD('price')} AS price, "
    f"{TD('freight_value')} AS freight_value FROM b_items",
    ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value"],
    ["order_id", "order_item_id"])

CTES["s_payments"] = dedup(
    f"SELECT {CL('order_id')} AS order_id, {TI('payment_sequential')} AS payment_sequential, "
    f"{LW('payment_type')} AS payment_type, "
    f"CASE WHEN {TI('payment_installments')} < 1 THEN 1 ELSE {TI('payment_installments')} END AS payment_installments, "
    f"{TD('payment_value')} AS payment_value FROM b_payments",
    ["order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"],
    ["order_id", "payment_sequential"])

CTES["s_reviews"] = dedup(
    f"SELECT * FROM (SELECT {CL('review_id')} AS review_id, {CL('order_id')} AS order_id, "
    f"{TI('review_score')} AS review_score, {TS('review_creation_date')} AS review_creation_date, "
    f"{TS('review_answer_timestamp')} AS review_answer_timestamp FROM b_reviews) r__ "
    f"WHERE review_score BETWEEN 1 AND 5 AND order_id IS NOT NULL",
    ["review_id", "order_id", "review_score", "review_creation_date", "review_answer_timestamp"],
    ["order_id"],
    ["review_answer_timestamp DESC NULLS LAST", "review_creation_date DESC NULLS LAST",
     "review_id ASC NULLS FIRST"])

CTES["s_translation"] = dedup(
    f"SELECT {LW('product_category_name')} AS product_category_name, "
    f"{LW('product_category_name_english')} AS product_category_name_english FROM b_translation",
    ["product_category_name", "product_category_name_english"], ["product_category_name"])

_PROD_COLS = ["product_id", "product_category_name", "product_name_length", "product_description_length",
              "product_photos_qty", "product_weight_g", "product_length_cm", "product_height_cm",
              "product_width_cm"]
CTES["s_products"] = (
    "SELECT p.product_category_name, p.product_id, p.product_name_length, p.product_description_length, "
    "p.product_photos_qty, CASE WHEN p.product_weight_g > 0 THEN p.product_weight_g END AS product_weight_g, "
    "p.product_length_cm, p.product_height_cm, p.product_width_cm, "
    "coalesce(t.product_category_name_english, p.product_category_name) AS product_category_name_english FROM ("
    + dedup(
        f"SELECT {CL('product_id')} AS product_id, "
        f"coalesce({LW('product_category_name')}, 'sem_categoria') AS product_category_name, "
        f"{TI('product_name_lenght')} AS product_name_length, "
        f"{TI('product_description_lenght')} AS product_description_length, "
        f"{TI('product_photos_qty')} AS product_photos_qty, {TI('product_weight_g')} AS product_weight_g, "
        f"{TI('product_length_cm')} AS product_length_cm, {TI('product_height_cm')} AS product_height_cm, "
        f"{TI('product_width_cm')} AS product_width_cm FROM b_products WHERE {CL('product_id')} IS NOT NULL",
        _PROD_COLS, ["product_id"])
    + ") p LEFT JOIN s_translation t ON p.product_category_name = t.product_category_name")

# ---------------------------------------------------------------- gold

CTES["g_dim_customer"] = (
    "SELECT customer_id, customer_unique_id, customer_zip_code_prefix AS zip_prefix, customer_city AS city, "
    f"customer_state AS state, {region_case('customer_state')} AS region FROM s_customers")
CTES["g_dim_seller"] = (
    "SELECT seller_id, seller_zip_code_prefix AS zip_prefix, seller_city AS city, seller_state AS state, "
    f"{region_case('seller_state')} AS region FROM s_sellers")
CTES["g_dim_product"] = (
    "SELECT product_id, product_category_name AS category, product_category_name_english AS category_en, "
    "product_photos_qty AS photos_qty, product_weight_g AS weight_g, product_length_cm AS length_cm, "
    "product_height_cm AS height_cm, product_width_cm AS width_cm FROM s_products")
CTES["g_dim_date"] = (
    f"SELECT {DKEY('d')} AS date_key, CAST(d AS DATE) AS \"date\", CAST(year(d) AS INTEGER) AS \"year\", "
    "CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS \"month\", "
    "strftime(d, '%Y-%m') AS year_month, CAST(dayofweek(d) + 1 AS INTEGER) AS weekday, "
    "dayofweek(d) IN (0, 6) AS is_weekend FROM (SELECT unnest(generate_series("
    "min(CAST(order_purchase_timestamp AS DATE)), max(CAST(order_purchase_timestamp AS DATE)), "
    "INTERVAL 1 DAY)) AS d FROM s_orders) c__")
CTES["g_fact_items"] = (
    "SELECT i.order_id, i.order_item_id AS item_id, o.customer_id, i.product_id, i.seller_id, "
    f"{DKEY('o.order_purchase_timestamp')} AS purchase_date_key, o.order_status, "
    "o.order_purchase_timestamp AS purchased_at, o.order_delivered_customer_date AS delivered_at, "
    "o.order_estimated_delivery_date AS estimated_at, "
    f"{DAYS('o.order_delivered_customer_date', 'o.order_purchase_timestamp')} AS lead_time_days, "
    f"{DAYS('o.order_delivered_customer_date', 'o.order_estimated_delivery_date')} AS delay_days, "
    "i.price AS item_price, i.freight_value, CAST(i.price + i.freight_value AS DECIMAL(13,2)) AS item_total, "
    f"r.review_score, {DAYS('o.order_delivered_customer_date', 'o.order_estimated_delivery_date')} > 0 AS is_late "
    "FROM s_items i JOIN s_orders o ON i.order_id = o.order_id LEFT JOIN s_reviews r ON i.order_id = r.order_id")
CTES["g_fact_payments"] = (
    "SELECT p.order_id, p.payment_sequential AS payment_seq, o.customer_id, "
    f"{DKEY('o.order_purchase_timestamp')} AS purchase_date_key, p.payment_type, "
    "p.payment_installments AS installments, p.payment_value "
    "FROM s_payments p JOIN s_orders o ON p.order_id = o.order_id")


def _deps(sql: str) -> list[str]:
    import re
    names = []
    for name in CTES:
        if re.search(rf"\b{name}\b", sql):
            names.append(name)
    return names


def with_ctes(body: str) -> str:
    """Prefix ``body`` with every CTE it needs, in dependency order."""
    needed: list[str] = []

    def visit(name):
        if name in needed:
            return
        for dep in _deps(CTES[name]):
            if dep != name:
                visit(dep)
        needed.append(name)

    for n in _deps(body):
        visit(n)
    if not needed:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in needed) + "\n" + body


# ---------------------------------------------------------------- reports

SOLD = "f.order_status NOT IN ('canceled', 'unavailable')"

Q: dict[str, str] = {}

Q["revenue_by_category"] = f"""
SELECT category, CAST(revenue AS DECIMAL(22,2)) AS revenue, orders,
       {RHU(f"{D} * CAST(revenue AS DOUBLE) / NULLIF(CAST(SUM(revenue) OVER () AS DOUBLE), 0)", 2)} AS pct_revenue
FROM (SELECT p.category, SUM(f.item_price) AS revenue, COUNT(DISTINCT f.order_id) AS orders
      FROM g_fact_items f JOIN g_dim_product p ON f.product_id = p.product_id
      WHERE {SOLD} GROUP BY p.category) g
ORDER BY revenue DESC, category ASC LIMIT 10"""

Q["monthly_top_categories"] = f"""
SELECT t.year_month, p.category, CAST(SUM(f.item_price) AS DECIMAL(22,2)) AS revenue
FROM g_fact_items f JOIN g_dim_product p ON f.product_id = p.product_id
JOIN g_dim_date t ON f.purchase_date_key = t.date_key
WHERE {SOLD}
  AND p.category IN (SELECT p2.category FROM g_fact_items f JOIN g_dim_product p2 ON f.product_id = p2.product_id
                     WHERE {SOLD} GROUP BY p2.category ORDER BY SUM(f.item_price) DESC, p2.category ASC LIMIT 5)
  AND t."date" BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'
GROUP BY t.year_month, p.category"""

_ORDERS_DR = ("SELECT DISTINCT order_id, delay_days, review_score FROM g_fact_items "
              "WHERE order_status = 'delivered' AND delivered_at IS NOT NULL AND review_score IS NOT NULL")

Q["delay_vs_score"] = f"""
SELECT CASE WHEN delay_days <= 0 THEN '1. on time or early' WHEN delay_days <= 3 THEN '2. 1 to 3 days late'
            WHEN delay_days <= 7 THEN '3. 4 to 7 days late' WHEN delay_days <= 14 THEN '4. 8 to 14 days late'
            ELSE '5. 15+ days late' END AS delay_band,
       COUNT(*) AS orders, {RHU("AVG(review_score)", 2)} AS mean_score,
       {PCT("review_score <= 2", 1)} AS pct_low_scores
FROM ({_ORDERS_DR}) o GROUP BY 1"""

Q["delay_score_corr"] = f"""
SELECT {RHU("corr(delay_days, review_score)", 3)} AS corr_delay_score,
       {PCT("delay_days > 0", 1)} AS pct_late_orders
FROM ({_ORDERS_DR}) o"""

Q["delivery_by_state"] = f"""
SELECT c.state, c.region, COUNT(*) AS orders, {RHU("AVG(o.lead_time_days)", 1)} AS mean_lead_days,
       quantile_disc(o.lead_time_days, 0.5) AS median_lead_days,
       {RHU(f"{D} * AVG(o.late)", 1)} AS pct_late,
       {RHU(f"{D} * CAST(SUM(o.freight_value) AS DOUBLE) / NULLIF(CAST(SUM(o.goods_value) AS DOUBLE), 0)", 1)} AS freight_pct_of_value
FROM (SELECT order_id, customer_id, MAX(lead_time_days) AS lead_time_days,
             MAX(CASE WHEN is_late THEN 1 ELSE 0 END) AS late, SUM(item_price) AS goods_value,
             SUM(freight_value) AS freight_value
      FROM g_fact_items WHERE order_status = 'delivered' AND delivered_at IS NOT NULL
      GROUP BY order_id, customer_id) o
JOIN g_dim_customer c ON o.customer_id = c.customer_id
GROUP BY c.state, c.region"""

Q["payment_mix"] = f"""
SELECT payment_type, orders, CAST(total_value AS DECIMAL(22,2)) AS total_value,
       {RHU(f"{D} * CAST(total_value AS DOUBLE) / NULLIF(CAST(SUM(total_value) OVER () AS DOUBLE), 0)", 1)} AS pct_of_value
FROM (SELECT payment_type, COUNT(DISTINCT order_id) AS orders, SUM(payment_value) AS total_value
      FROM g_fact_payments WHERE payment_type <> 'not_defined' GROUP BY payment_type) g"""

Q["instalments_by_value_band"] = f"""
SELECT CASE WHEN order_value < 50 THEN '1. up to 50' WHEN order_value < 100 THEN '2. 50 to 100'
            WHEN order_value < 200 THEN '3. 100 to 200' WHEN order_value < 500 THEN '4. 200 to 500'
            ELSE '5. above 500' END AS value_band,
       COUNT(*) AS card_orders, {RHU("AVG(card_installments)", 1)} AS mean_installments,
       {PCT("card_installments > 1", 1)} AS pct_in_installments
FROM (SELECT order_id, SUM(payment_value) AS order_value,
             MAX(CASE WHEN payment_type = 'credit_card' THEN installments END) AS card_installments
      FROM g_fact_payments GROUP BY order_id) p
WHERE card_installments IS NOT NULL GROUP BY 1"""

Q["domain_frequency"] = """
SELECT 'order_status' AS domain, order_status AS value, COUNT(*) AS n FROM b_orders GROUP BY order_status
UNION ALL SELECT 'payment_type', payment_type, COUNT(*) FROM b_payments GROUP BY payment_type
UNION ALL SELECT 'customer_state', customer_state, COUNT(*) FROM b_customers GROUP BY customer_state"""

# ---------------------------------------------------------------- column builders

Q["clean_text"] = (f"SELECT customer_id AS raw_id, {CL('customer_id')} AS customer_id, "
                   f"{CL('customer_city')} AS city_clean, {LW('customer_city')} AS city_lower, "
                   f"{UP('customer_state')} AS state_upper FROM b_customers")
Q["clean_zip"] = (f"SELECT {CL('customer_id')} AS customer_id, customer_zip_code_prefix AS zip_raw, "
                  f"lpad({CL('customer_zip_code_prefix')}, 5, '0') AS zip_prefix FROM b_customers")
Q["typed_cast"] = (f"SELECT order_id, order_item_id AS item_raw, {TI('order_item_id')} AS item_id, "
                   f"{TD('price')} AS price, {TD('freight_value')} AS freight_value, "
                   f"{TS('shipping_limit_date')} AS shipping_limit FROM b_items")
Q["map_lookup"] = (f"SELECT {CL('seller_id')} AS seller_id, {UP('seller_state')} AS state, "
                   f"{region_case(UP('seller_state'))} AS region FROM b_sellers")
Q["clamp_min"] = "SELECT * FROM s_payments"
Q["null_nonpositive"] = (f"SELECT {CL('product_id')} AS product_id, {TI('product_weight_g')} AS weight_raw, "
                         f"CASE WHEN {TI('product_weight_g')} > 0 THEN {TI('product_weight_g')} END AS weight_g "
                         f"FROM b_products")
Q["null_inconsistent_date"] = "SELECT * FROM s_orders"
Q["enrich_category"] = "SELECT * FROM s_products"

# ---------------------------------------------------------------- dedup

_ITEM_COLS = ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value"]
Q["dedup_key"] = dedup("SELECT * FROM s_items WHERE order_id IS NOT NULL", _ITEM_COLS, ["order_id"],
                       ["price DESC NULLS LAST"])
Q["dedup_composite"] = "SELECT * FROM s_items"
Q["latest_per_key"] = "SELECT * FROM s_reviews"
Q["silver_customers"] = "SELECT * FROM s_customers"
Q["silver_sellers"] = "SELECT * FROM s_sellers"

# ---------------------------------------------------------------- uniqueness and integrity

_SURPLUS = [
    ("orders", "b_orders", ["order_id"]), ("customers", "b_customers", ["customer_id"]),
    ("products", "b_products", ["product_id"]), ("sellers", "b_sellers", ["seller_id"]),
    ("order_items", "b_items", ["order_id", "order_item_id"]),
    ("geolocation", "b_geolocation", ["geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng",
                                      "geolocation_city", "geolocation_state"]),
]


def _surplus_sql(table, view, keys, null_safe):
    tup = f"row({', '.join(keys)})"
    if null_safe:
        distinct = f"COUNT(DISTINCT {tup})"
    else:
        notnull = " AND ".join(f"{k} IS NOT NULL" for k in keys)
        distinct = f"COUNT(DISTINCT CASE WHEN {notnull} THEN {tup} END)"
    return (f"SELECT '{table}' AS \"table\", '{','.join(keys)}' AS keys, {str(null_safe).upper()} AS null_safe, "
            f"COUNT(*) AS \"rows\", {distinct} AS distinct_keys, COUNT(*) - {distinct} AS surplus FROM {view}")


Q["duplicate_surplus"] = "\nUNION ALL\n".join(_surplus_sql(t, v, k, ns) for t, v, k in _SURPLUS for ns in (False, True))

Q["duplicate_keys"] = """
SELECT 'order_reviews' AS "table", COUNT(*) FILTER (WHERE n > 1) AS keys_with_duplicates
FROM (SELECT order_id, COUNT(*) AS n FROM b_reviews GROUP BY order_id) a
UNION ALL
SELECT 'order_items', COUNT(*) FILTER (WHERE n > 1)
FROM (SELECT order_id, order_item_id, COUNT(*) AS n FROM b_items GROUP BY order_id, order_item_id) b"""

_UNIQUE = [("customers", "s_customers", ["customer_id"]), ("sellers", "s_sellers", ["seller_id"]),
           ("orders", "s_orders", ["order_id"]), ("order_items", "s_items", ["order_id", "order_item_id"]),
           ("order_payments", "s_payments", ["order_id", "payment_sequential"]),
           ("order_reviews", "s_reviews", ["order_id"]), ("products", "s_products", ["product_id"])]
_ORPHANS = [("order_items", "s_items", "orders", "s_orders", "order_id"),
            ("order_items", "s_items", "products", "s_products", "product_id"),
            ("order_items", "s_items", "sellers", "s_sellers", "seller_id"),
            ("orders", "s_orders", "customers", "s_customers", "customer_id"),
            ("order_payments", "s_payments", "orders", "s_orders", "order_id")]

_UNIQUE_SQL = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS \"table\", 'unique {','.join(k)}' AS \"check\", "
    f"COUNT(*) - COUNT(DISTINCT row({', '.join(k)})) AS violations, 'error' AS severity FROM {v}"
    for t, v, k in _UNIQUE)
_ORPHAN_SQL = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"table\", 'rows without match in {p} ({k})' AS \"check\", COUNT(*) AS violations, "
    f"'warn' AS severity FROM {cv} c WHERE NOT EXISTS (SELECT 1 FROM {pv} p WHERE p.{k} = c.{k})"
    for c, cv, p, pv, k in _ORPHANS)
Q["check_unique"] = _UNIQUE_SQL + "\nUNION ALL\n" + "\nUNION ALL\n".join(
    f"SELECT 'bronze.{t}' AS \"table\", 'unique {','.join(k)}' AS \"check\", "
    f"COUNT(*) - COUNT(DISTINCT row({', '.join(k)})) AS violations, 'warn' AS severity FROM {v.replace('s_', 'b_', 1)}"
    for t, v, k in _UNIQUE)
Q["check_orphans"] = _ORPHAN_SQL
Q["integrity_report"] = _UNIQUE_SQL + "\nUNION ALL\n" + _ORPHAN_SQL

Q["row_conservation"] = """
SELECT CAST(SUM(coalesce(nb, 0)) AS BIGINT) AS rows_before, CAST(SUM(coalesce(na, 0)) AS BIGINT) AS rows_after,
       CAST(SUM(greatest(coalesce(nb, 0) - coalesce(na, 0), 0)) AS BIGINT) AS missing,
       CAST(SUM(greatest(coalesce(na, 0) - coalesce(nb, 0), 0)) AS BIGINT) AS extra
FROM (SELECT order_id, order_item_id, COUNT(*) AS nb FROM s_items GROUP BY order_id, order_item_id) b
FULL OUTER JOIN (SELECT order_id, item_id, COUNT(*) AS na FROM g_fact_items GROUP BY order_id, item_id) a
  ON b.order_id IS NOT DISTINCT FROM a.order_id AND b.order_item_id IS NOT DISTINCT FROM a.item_id"""

# ---------------------------------------------------------------- star schema

Q["dim_customer"] = "SELECT * FROM g_dim_customer"
Q["dim_supplier"] = "SELECT * FROM g_dim_seller"
Q["dim_product"] = "SELECT * FROM g_dim_product"
Q["dim_date"] = "SELECT * FROM g_dim_date"
Q["fact_items"] = "SELECT * FROM g_fact_items"
Q["fact_payments"] = "SELECT * FROM g_fact_payments"

# ---------------------------------------------------------------- profiling and quality

_PROFILED = {"customers": "b_customers", "sellers": "b_sellers", "orders": "b_orders",
             "order_items": "b_items", "order_payments": "b_payments", "order_reviews": "b_reviews",
             "products": "b_products", "geolocation": "b_geolocation", "category_translation": "b_translation"}


def _profile_sql(table, view):
    parts = []
    for c in LANDING_COLUMNS[view]:
        nulls = f"COUNT(*) FILTER (WHERE {c} IS NULL OR trim({c}) = '')"
        pct = f"CASE WHEN COUNT(*) > 0 THEN {RHU(f'{D} * {nulls} / COUNT(*)', 2)} ELSE CAST(0 AS DOUBLE) END"
        parts.append(f"SELECT '{table}' AS \"table\", '{c}' AS \"column\", COUNT(*) AS total_rows, "
                     f"{nulls} AS null_or_blank, {pct} AS pct_null, COUNT(DISTINCT {c}) AS distinct_values "
                     f"FROM {view}")
    return "\nUNION ALL\n".join(parts)


Q["column_profile"] = "\nUNION ALL\n".join(_profile_sql(t, v) for t, v in _PROFILED.items())
Q["column_profile_approx"] = (f"SELECT \"table\", \"column\", total_rows, null_or_blank, pct_null, "
                              f"TRUE AS distinct_within_bound FROM ({Q['column_profile']}) p")


def _dist_sql(label, view, col):
    v = DBL(col)
    return (f"SELECT '{label}' AS field, MIN({v}) AS min_value, quantile_disc({v}, 0.5) AS median_value, "
            f"{RHU(f'AVG({v})', 2)} AS mean_value, MAX({v}) AS max_value FROM {view}")


Q["numeric_distribution"] = "\nUNION ALL\n".join([
    _dist_sql("price", "b_items", "price"), _dist_sql("freight_value", "b_items", "freight_value"),
    _dist_sql("payment_value", "b_payments", "payment_value"),
    _dist_sql("review_score", "b_reviews", "review_score")])


def _summary_sql(col):
    v = f"CAST({col} AS DOUBLE)"
    return (f"SELECT '{col}' AS \"column\", COUNT({v}) AS \"count\", MIN({v}) AS min_value, "
            f"quantile_disc({v}, 0.5) AS median_value, MAX({v}) AS max_value FROM g_fact_items")


Q["numeric_summary"] = "\nUNION ALL\n".join(
    _summary_sql(c) for c in ["lead_time_days", "delay_days", "item_price", "freight_value", "review_score"])


def _iqr_sql(table, view, col):
    v = DBL(col)
    fence = "s.q3 + CAST(1.5 AS DOUBLE) * (s.q3 - s.q1)"
    return (f"SELECT '{table}' AS \"table\", '{col}' AS \"column\", s.q1, s.q3, {fence} AS upper_fence, "
            f"(SELECT COUNT(*) FROM {view} x WHERE {DBL('x.' + col)} > {fence}) AS outliers "
            f"FROM (SELECT quantile_disc({v}, 0.25) AS q1, quantile_disc({v}, 0.75) AS q3 FROM {view}) s")


Q["iqr_outliers"] = "\nUNION ALL\n".join([
    _iqr_sql("order_items", "b_items", "price"), _iqr_sql("order_items", "b_items", "freight_value"),
    _iqr_sql("order_payments", "b_payments", "payment_value"), _iqr_sql("events", "events", "value")])

# The 23 rule counts, in the order of ``_RULE_NAMES``.
_RULE_COUNTS = [
    "SELECT COUNT(*) - COUNT(DISTINCT order_id) FROM b_orders",
    "SELECT COUNT(*) - COUNT(DISTINCT customer_id) FROM b_customers",
    "SELECT COUNT(*) - COUNT(DISTINCT product_id) FROM b_products",
    "SELECT COUNT(*) - COUNT(DISTINCT seller_id) FROM b_sellers",
    "SELECT COUNT(*) - COUNT(DISTINCT CASE WHEN order_id IS NOT NULL AND order_item_id IS NOT NULL "
    "THEN row(order_id, order_item_id) END) FROM b_items",
    "SELECT COUNT(*) FROM (SELECT order_id FROM b_reviews GROUP BY order_id HAVING COUNT(*) > 1) x",
    "SELECT COUNT(*) - COUNT(DISTINCT CASE WHEN geolocation_zip_code_prefix IS NOT NULL AND geolocation_lat IS NOT NULL "
    "AND geolocation_lng IS NOT NULL AND geolocation_city IS NOT NULL AND geolocation_state IS NOT NULL THEN "
    "row(geolocation_zip_code_prefix, geolocation_lat, geolocation_lng, geolocation_city, geolocation_state) END) "
    "FROM b_geolocation",
    "SELECT COUNT(*) FROM b_orders WHERE order_status = 'delivered' AND order_delivered_customer_date IS NULL",
    "SELECT COUNT(*) FROM b_products WHERE product_category_name IS NULL",
    "SELECT COUNT(*) FROM b_reviews WHERE review_comment_message IS NULL",
    f"SELECT COUNT(*) FROM b_orders WHERE order_purchase_timestamp IS NOT NULL AND {TS('order_purchase_timestamp')} IS NULL",
    f"SELECT COUNT(*) FROM b_orders WHERE {TS('order_delivered_customer_date')} < {TS('order_purchase_timestamp')}",
    "SELECT COUNT(*) FROM b_customers WHERE length(trim(customer_zip_code_prefix)) <> 5",
    "SELECT COUNT(DISTINCT p.product_category_name) FROM b_products p LEFT JOIN b_translation t "
    "ON p.product_category_name = t.product_category_name "
    "WHERE p.product_category_name IS NOT NULL AND t.product_category_name IS NULL",
    f"SELECT COUNT(*) FROM b_items WHERE {DBL('price')} <= 0",
    f"SELECT COUNT(*) FROM b_items WHERE {DBL('freight_value')} < 0",
    f"SELECT COUNT(*) FROM b_reviews WHERE coalesce({TI('review_score')}, 0) NOT BETWEEN 1 AND 5",
    f"SELECT COUNT(*) FROM b_payments WHERE {TI('payment_installments')} = 0",
    "SELECT COUNT(*) FROM b_payments WHERE payment_type = 'not_defined'",
    f"SELECT COUNT(*) FROM b_products WHERE {DBL('product_weight_g')} = 0",
    f"SELECT COUNT(*) FROM b_geolocation WHERE NOT ({DBL('geolocation_lat')} BETWEEN -34 AND 6 "
    f"AND {DBL('geolocation_lng')} BETWEEN -74 AND -34)",
    f"WITH q AS (SELECT quantile_disc({DBL('price')}, 0.25) AS q1, quantile_disc({DBL('price')}, 0.75) AS q3 FROM b_items) "
    f"SELECT COUNT(*) FROM b_items, q WHERE {DBL('price')} > q.q3 + 1.5 * (q.q3 - q.q1)",
    f"WITH q AS (SELECT quantile_disc({DBL('freight_value')}, 0.25) AS q1, quantile_disc({DBL('freight_value')}, 0.75) AS q3 "
    f"FROM b_items) SELECT COUNT(*) FROM b_items, q WHERE {DBL('freight_value')} > q.q3 + 1.5 * (q.q3 - q.q1)",
]


def _lit(s):
    return "'" + s.replace("'", "''") + "'"


_RULE_NAMES = [
    ("uniqueness", "orders", "surplus rows by order_id", "one row per key"),
    ("uniqueness", "customers", "surplus rows by customer_id", "one row per key"),
    ("uniqueness", "products", "surplus rows by product_id", "one row per key"),
    ("uniqueness", "sellers", "surplus rows by seller_id", "one row per key"),
    ("uniqueness", "order_items", "surplus rows by order_id + order_item_id", "one row per key"),
    ("uniqueness", "order_reviews", "order_id with several reviews", "newest valid review"),
    ("uniqueness", "geolocation", "surplus rows by all columns", "not read further"),
    ("completeness", "orders", "delivered, order_delivered_customer_date absent", "no delivery measures"),
    ("completeness", "products", "product_category_name absent", "set to sem_categoria"),
    ("completeness", "order_reviews", "review_comment_message absent", "kept"),
    ("consistency", "orders", "order_purchase_timestamp unreadable", "set to NULL"),
    ("consistency", "orders", "order_delivered_customer_date before order_purchase_timestamp", "set to NULL"),
    ("consistency", "customers", "customer_zip_code_prefix not of length 5", "padded with zeros"),
    ("consistency", "products", "product_category_name not in category_translation", "original name"),
    ("accuracy", "order_items", "price is 0 or less", "kept"),
    ("accuracy", "order_items", "freight_value below 0", "kept"),
    ("accuracy", "order_reviews", "review_score not within 1 to 5", "row dropped"),
    ("accuracy", "order_payments", "payment_installments is 0", "raised to 1"),
    ("accuracy", "order_payments", "payment_type is not_defined", "left out of reports"),
    ("accuracy", "products", "product_weight_g is 0", "set to NULL"),
    ("accuracy", "geolocation", "coordinates outside the box", "not read further"),
    ("outliers", "order_items", "price beyond the upper fence", "kept"),
    ("outliers", "order_items", "freight_value beyond the upper fence", "kept"),
]


def _dq_sql():
    parts = [f"SELECT {_lit(d)} AS dimension, {_lit(t)} AS \"table\", {_lit(c)} AS \"check\", "
             f"CAST(({sql}) AS BIGINT) AS occurrences, {_lit(r)} AS treatment"
             for (d, t, c, r), sql in zip(_RULE_NAMES, _RULE_COUNTS, strict=True)]
    return "\nUNION ALL\n".join(parts)


Q["dq_checks"] = _dq_sql()

Q["dq_untranslated"] = """
SELECT 'landing' AS layer, COUNT(DISTINCT p.product_category_name) AS missing
FROM b_products p LEFT JOIN b_translation t ON p.product_category_name = t.product_category_name
WHERE p.product_category_name IS NOT NULL AND t.product_category_name IS NULL
UNION ALL
SELECT 'silver', COUNT(DISTINCT p.product_category_name)
FROM s_products p LEFT JOIN s_translation t ON p.product_category_name = t.product_category_name
WHERE p.product_category_name IS NOT NULL AND t.product_category_name IS NULL"""

def _missing(column, view, key):
    return f"{column} NOT IN (SELECT {key} FROM {view} WHERE {key} IS NOT NULL)"


def _among(column, members):
    return f"{column} NOT IN ({', '.join(_lit(x) for x in members)})"


_STATES, _REGIONS = sorted(state_region_map()), sorted(set(state_region_map().values()))
_ORDER_STATES = ["delivered", "shipped", "canceled", "unavailable", "invoiced", "processing", "created", "approved"]
_PAY_TYPES = ["credit_card", "boleto", "voucher", "debit_card", "not_defined"]


def _place_domains(key):
    return [(key, "required", f"{key} IS NULL"),
            ("zip_prefix", "like ^[0-9]{5}$", "NOT regexp_matches(zip_prefix, '^[0-9]{5}$')"),
            ("state", "one of " + ", ".join(_STATES), _among("state", _STATES)),
            ("region", "one of " + ", ".join(_REGIONS), _among("region", _REGIONS))]


#: table -> (view, [(column, domain, when a row breaks it)])
_DOMAINS = {
    "dim_customer": ("g_dim_customer", _place_domains("customer_id")),
    "dim_seller": ("g_dim_seller", _place_domains("seller_id")),
    "dim_product": ("g_dim_product", [
        ("product_id", "required", "product_id IS NULL"), ("category", "required", "category IS NULL"),
        ("photos_qty", "at least 1", "photos_qty < 1"), ("weight_g", "above 0", "weight_g <= 0"),
        ("length_cm", "above 0", "length_cm <= 0"), ("height_cm", "above 0", "height_cm <= 0"),
        ("width_cm", "above 0", "width_cm <= 0")]),
    "fact_order_items": ("g_fact_items", [
        ("order_id", "required", "order_id IS NULL"),
        ("item_id", "required, at least 1", "item_id IS NULL OR item_id < 1"),
        ("purchase_date_key", "key of dim_date.date_key", _missing("purchase_date_key", "g_dim_date", "date_key")),
        ("customer_id", "required, key of dim_customer.customer_id",
         "customer_id IS NULL OR " + _missing("customer_id", "g_dim_customer", "customer_id")),
        ("product_id", "required, key of dim_product.product_id",
         "product_id IS NULL OR " + _missing("product_id", "g_dim_product", "product_id")),
        ("seller_id", "required, key of dim_seller.seller_id",
         "seller_id IS NULL OR " + _missing("seller_id", "g_dim_seller", "seller_id")),
        ("item_price", "required, above 0", "item_price IS NULL OR item_price <= 0"),
        ("freight_value", "required, at least 0", "freight_value IS NULL OR freight_value < 0"),
        ("order_status", "one of " + ", ".join(_ORDER_STATES), _among("order_status", _ORDER_STATES)),
        ("review_score", "1 to 5", "review_score < 1 OR review_score > 5"),
        ("lead_time_days", "at least 0", "lead_time_days < 0")]),
    "fact_payments": ("g_fact_payments", [
        ("order_id", "required", "order_id IS NULL"),
        ("payment_seq", "required, at least 1", "payment_seq IS NULL OR payment_seq < 1"),
        ("purchase_date_key", "key of dim_date.date_key", _missing("purchase_date_key", "g_dim_date", "date_key")),
        ("customer_id", "required, key of dim_customer.customer_id",
         "customer_id IS NULL OR " + _missing("customer_id", "g_dim_customer", "customer_id")),
        ("payment_type", "one of " + ", ".join(_PAY_TYPES), _among("payment_type", _PAY_TYPES)),
        ("installments", "at least 1", "installments < 1"), ("payment_value", "at least 0", "payment_value < 0")]),
    "dim_date": ("g_dim_date", [
        ("date_key", "required", "date_key IS NULL"), ("month", "1 to 12", '"month" < 1 OR "month" > 12'),
        ("quarter", "1 to 4", "quarter < 1 OR quarter > 4"), ("weekday", "1 to 7", "weekday < 1 OR weekday > 7")]),
}
Q["dictionary_domains"] = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", {_lit(text)} AS domain, COUNT(*) AS \"rows\", "
    f"COUNT(*) FILTER (WHERE \"{c}\" IS NULL) AS empty, COUNT(*) FILTER (WHERE {broken}) AS violations FROM {view}"
    for t, (view, of) in _DOMAINS.items() for c, text, broken in of)
Q["domain_quarantine"] = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS \"table\", v AS violations, COUNT(*) AS \"rows\" FROM (SELECT concat_ws(',', "
    + ", ".join(f"CASE WHEN {broken} THEN '{c}' END" for c, _, broken in sorted(of)) + f") AS v FROM {view}) q__ WHERE v <> '' GROUP BY v"
    for t, (view, of) in _DOMAINS.items())

# ---------------------------------------------------------------- sources and sinks

Q["load_summary"] = "\nUNION ALL\n".join(f"SELECT '{t}' AS \"table\", COUNT(*) AS \"rows\" FROM {v}"
                                         for t, v in _PROFILED.items())
Q["src_csv_roundtrip"] = "SELECT * FROM s_orders"
Q["src_provenance"] = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS source, COUNT(*) AS \"rows\" FROM {v}" for t, v in _PROFILED.items())
Q["stream_ingest"] = "SELECT * FROM s_orders"
_RUN_TABLES = (
    [("bronze", n, v) for n, v in [("customers", "b_customers"), ("sellers", "b_sellers"), ("orders", "b_orders"),
                                   ("order_items", "b_items"), ("order_payments", "b_payments"),
                                   ("order_reviews", "b_reviews"), ("products", "b_products"),
                                   ("geolocation", "b_geolocation"), ("category_translation", "b_translation")]]
    + [("silver", n, v) for n, v in [("customers", "s_customers"), ("sellers", "s_sellers"), ("orders", "s_orders"),
                                     ("order_items", "s_items"), ("order_payments", "s_payments"),
                                     ("order_reviews", "s_reviews"), ("category_translation", "s_translation"),
                                     ("products", "s_products")]]
    + [("gold", n, v) for n, v in [("dim_customer", "g_dim_customer"), ("dim_seller", "g_dim_seller"),
                                   ("dim_product", "g_dim_product"), ("dim_date", "g_dim_date"),
                                   ("fact_order_items", "g_fact_items"), ("fact_payments", "g_fact_payments")]])
Q["medallion_run"] = "\nUNION ALL\n".join(
    f"SELECT '{layer}.{name}' AS \"table\", COUNT(*) AS \"rows\" FROM {view}" for layer, name, view in _RUN_TABLES)
Q["medallion_csv"] = "\nUNION ALL\n".join([
    f"SELECT 'rule' AS part, \"table\" AS item, \"check\" AS name, occurrences AS n FROM ({Q['dq_checks']}) a",
    f"SELECT 'integrity', \"table\", \"check\", violations FROM ({Q['integrity_report']}) b",
    f"SELECT 'domain', domain, value, n FROM ({Q['domain_frequency']}) c",
    f"SELECT 'revenue', category, CAST(revenue AS VARCHAR), orders FROM ({Q['revenue_by_category']}) d"] + [
    f"SELECT 'source', '{layer}.{name}', {_lit(name + '.csv') if layer == 'bronze' else 'NULL'}, COUNT(*) FROM {view}"
    for layer, name, view in _RUN_TABLES])
Q["sink_overwrite"] = "SELECT * FROM s_sellers"

# the documented gold columns: table, position, column, type, comment
_GOLD_COLUMNS = [
    ("dim_customer", 1, "customer_id", "string",
     "Key. Domain: required. From bronze.customers.customer_id > silver.customers.customer_id (trimmed text)."),
    ("dim_customer", 2, "customer_unique_id", "string",
     "The person, who may stand behind several keys. From bronze.customers.customer_unique_id > silver.customers.customer_unique_id (trimmed text)."),
    ("dim_customer", 3, "zip_prefix", "string",
     "Leading five digits of the postal code. Domain: like ^[0-9]{5}$. From bronze.customers.customer_zip_code_prefix > silver.customers.customer_zip_code_prefix (zero-padded code)."),
    ("dim_customer", 4, "city", "string",
     "City. From bronze.customers.customer_city > silver.customers.customer_city (trimmed lower-case text)."),
    ("dim_customer", 5, "state", "string",
     "State code. From bronze.customers.customer_state > silver.customers.customer_state (trimmed upper-case text)."),
    ("dim_customer", 6, "region", "string",
     "Region of the customer's state, empty for an unlisted state. Derived in gold: region. From bronze.customers.customer_state > silver.customers.customer_state (trimmed upper-case text)."),
    ("dim_date", 1, "date_key", "int",
     "Key, year month day as one number. Domain: required."),
    ("dim_date", 2, "date", "date",
     "The day."),
    ("dim_date", 3, "year_month", "string",
     "Month for series."),
    ("dim_date", 4, "year", "int",
     "Calendar year."),
    ("dim_date", 5, "month", "int",
     "Month number. Domain: 1 to 12."),
    ("dim_date", 6, "quarter", "int",
     "Quarter number. Domain: 1 to 4."),
    ("dim_date", 7, "weekday", "int",
     "Day of the week, Sunday is 1. Domain: 1 to 7."),
    ("dim_date", 8, "is_weekend", "boolean",
     "Whether Saturday or Sunday."),
    ("dim_product", 1, "product_id", "string",
     "Key. Domain: required. From bronze.products.product_id > silver.products.product_id (trimmed text)."),
    ("dim_product", 2, "category", "string",
     "Category, never empty. Domain: required. From bronze.products.product_category_name > silver.products.product_category_name (trimmed lower-case text)."),
    ("dim_product", 3, "category_en", "string",
     "Category in English, as landed where untranslated. From bronze.category_translation.product_category_name_english > silver.category_translation.product_category_name_english (trimmed lower-case text)."),
    ("dim_product", 4, "photos_qty", "int",
     "Photos in the listing. Domain: at least 1. From bronze.products.product_photos_qty > silver.products.product_photos_qty (whole number)."),
    ("dim_product", 5, "weight_g", "int",
     "Weight in grams, empty where not positive. Domain: above 0. From bronze.products.product_weight_g > silver.products.product_weight_g (whole number)."),
    ("dim_product", 6, "length_cm", "int",
     "Package length in centimetres. Domain: above 0. From bronze.products.product_length_cm > silver.products.product_length_cm (whole number)."),
    ("dim_product", 7, "height_cm", "int",
     "Package height in centimetres. Domain: above 0. From bronze.products.product_height_cm > silver.products.product_height_cm (whole number)."),
    ("dim_product", 8, "width_cm", "int",
     "Package width in centimetres. Domain: above 0. From bronze.products.product_width_cm > silver.products.product_width_cm (whole number)."),
    ("dim_seller", 1, "seller_id", "string",
     "Key. Domain: required. From bronze.sellers.seller_id > silver.sellers.seller_id (trimmed text)."),
    ("dim_seller", 2, "zip_prefix", "string",
     "Leading five digits of the postal code. Domain: like ^[0-9]{5}$. From bronze.sellers.seller_zip_code_prefix > silver.sellers.seller_zip_code_prefix (zero-padded code)."),
    ("dim_seller", 3, "city", "string",
     "City. From bronze.sellers.seller_city > silver.sellers.seller_city (trimmed lower-case text)."),
    ("dim_seller", 4, "state", "string",
     "State code. From bronze.sellers.seller_state > silver.sellers.seller_state (trimmed upper-case text)."),
    ("dim_seller", 5, "region", "string",
     "Region of the seller's state, empty for an unlisted state. Derived in gold: region. From bronze.sellers.seller_state > silver.sellers.seller_state (trimmed upper-case text)."),
    ("fact_order_items", 1, "order_id", "string",
     "Key, with item_id. Domain: required. From bronze.order_items.order_id > silver.order_items.order_id (trimmed text)."),
    ("fact_order_items", 2, "item_id", "int",
     "Key, with order_id. Domain: required, at least 1. From bronze.order_items.order_item_id > silver.order_items.order_item_id (whole number)."),
    ("fact_order_items", 3, "purchase_date_key", "int",
     "Day of purchase. Domain: key of dim_date.date_key. Derived in gold: day key. From bronze.orders.order_purchase_timestamp > silver.orders.order_purchase_timestamp (date and time)."),
    ("fact_order_items", 4, "customer_id", "string",
     "Who bought. Domain: required, key of dim_customer.customer_id. From bronze.orders.customer_id > silver.orders.customer_id (trimmed text)."),
    ("fact_order_items", 5, "product_id", "string",
     "What was sold. Domain: required, key of dim_product.product_id. From bronze.order_items.product_id > silver.order_items.product_id (trimmed text)."),
    ("fact_order_items", 6, "seller_id", "string",
     "Who sold it. Domain: required, key of dim_seller.seller_id. From bronze.order_items.seller_id > silver.order_items.seller_id (trimmed text)."),
    ("fact_order_items", 7, "item_price", "decimal(12,2)",
     "Price of the item. Domain: required, above 0. From bronze.order_items.price > silver.order_items.price (amount with two decimals)."),
    ("fact_order_items", 8, "freight_value", "decimal(12,2)",
     "Freight of the item. Domain: required, at least 0. From bronze.order_items.freight_value > silver.order_items.freight_value (amount with two decimals)."),
    ("fact_order_items", 9, "item_total", "decimal(13,2)",
     "Price and freight. Derived in gold: sum. From bronze.order_items.price > silver.order_items.price (amount with two decimals); bronze.order_items.freight_value > silver.order_items.freight_value (amount with two decimals)."),
    ("fact_order_items", 10, "order_status", "string",
     "State the order is in. Domain: one of delivered, shipped, canceled, unavailable, invoiced, processing, created, approved. From bronze.orders.order_status > silver.orders.order_status (trimmed lower-case text)."),
    ("fact_order_items", 11, "review_score", "int",
     "Score of the order's newest valid review. Domain: 1 to 5. From bronze.order_reviews.review_score > silver.order_reviews.review_score (whole number)."),
    ("fact_order_items", 12, "purchased_at", "timestamp_ntz",
     "Moment of purchase. From bronze.orders.order_purchase_timestamp > silver.orders.order_purchase_timestamp (date and time)."),
    ("fact_order_items", 13, "estimated_at", "timestamp_ntz",
     "Delivery as promised. From bronze.orders.order_estimated_delivery_date > silver.orders.order_estimated_delivery_date (date and time)."),
    ("fact_order_items", 14, "delivered_at", "timestamp_ntz",
     "Delivery as made, empty if before the purchase. From bronze.orders.order_delivered_customer_date > silver.orders.order_delivered_customer_date (date and time)."),
    ("fact_order_items", 15, "lead_time_days", "int",
     "Days the customer waited. Domain: at least 0. Derived in gold: days from. From bronze.orders.order_purchase_timestamp > silver.orders.order_purchase_timestamp (date and time); bronze.orders.order_delivered_customer_date > silver.orders.order_delivered_customer_date (date and time)."),
    ("fact_order_items", 16, "delay_days", "int",
     "Days past the promise, below zero when early. Derived in gold: days from. From bronze.orders.order_estimated_delivery_date > silver.orders.order_estimated_delivery_date (date and time); bronze.orders.order_delivered_customer_date > silver.orders.order_delivered_customer_date (date and time)."),
    ("fact_order_items", 17, "is_late", "boolean",
     "Whether it came after the promised day. Derived in gold: late. From bronze.orders.order_delivered_customer_date > silver.orders.order_delivered_customer_date (date and time); bronze.orders.order_estimated_delivery_date > silver.orders.order_estimated_delivery_date (date and time)."),
    ("fact_payments", 1, "order_id", "string",
     "Key, with payment_seq. Domain: required. From bronze.order_payments.order_id > silver.order_payments.order_id (trimmed text)."),
    ("fact_payments", 2, "payment_seq", "int",
     "Key, with order_id. Domain: required, at least 1. From bronze.order_payments.payment_sequential > silver.order_payments.payment_sequential (whole number)."),
    ("fact_payments", 3, "purchase_date_key", "int",
     "Day of purchase. Domain: key of dim_date.date_key. Derived in gold: day key. From bronze.orders.order_purchase_timestamp > silver.orders.order_purchase_timestamp (date and time)."),
    ("fact_payments", 4, "customer_id", "string",
     "Who bought. Domain: required, key of dim_customer.customer_id. From bronze.orders.customer_id > silver.orders.customer_id (trimmed text)."),
    ("fact_payments", 5, "payment_type", "string",
     "Means of payment. Domain: one of credit_card, boleto, voucher, debit_card, not_defined. From bronze.order_payments.payment_type > silver.order_payments.payment_type (trimmed lower-case text)."),
    ("fact_payments", 6, "installments", "int",
     "Instalments. Domain: at least 1. From bronze.order_payments.payment_installments > silver.order_payments.payment_installments (whole number)."),
    ("fact_payments", 7, "payment_value", "decimal(12,2)",
     "Amount. Domain: at least 0. From bronze.order_payments.payment_value > silver.order_payments.payment_value (amount with two decimals)."),
]
Q["catalog_dictionary"] = "SELECT * FROM (VALUES " + ",\n".join(
    f"({_lit(t)}, {i}, {_lit(c)}, {_lit(k)}, {_lit(about)})" for t, i, c, k, about in _GOLD_COLUMNS
) + ") v(\"table\", \"position\", \"column\", data_type, \"comment\")"


def oracle_sql() -> dict[str, str]:
    return {k: with_ctes(v) for k, v in Q.items()}
