"""Landing (bronze) tables of the retail model, derived from the driver's
TPC-H-like tables.

The retail pipeline expects nine text-only source tables (customers,
sellers, orders, order items, payments, reviews, products, a category
translation and geolocation). The test data has none of them, so each is
derived deterministically from the driver's tables, in the shape a text
landing zone delivers: every column a string, with the dirt the cleaning
layer exists for - padded and blank text, '40.0'-style integers,
date-only and unparsable timestamps, duplicate keys, rows delivered twice,
blank, NULL and orphan keys, zero weights and instalments, prices that are not
positive or far out, negative freight, untranslated categories, out-of-range
coordinates.

The derivations are Spark SQL text with ``{table}`` placeholders; the
same text (placeholders replaced by view names) serves the DuckDB oracle,
so both engines start from identical inputs. CASE expressions on key
arithmetic only choose *values* to make dirty; no row is ever filtered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .tables import TableSet

LANDING_SQL: dict[str, str] = {
    "customers": """
SELECT CASE WHEN c.c_custkey % 151 = 0 THEN '  ' ELSE concat(' ', CAST(c.c_custkey AS STRING), ' ') END AS customer_id,
       c.c_name AS customer_unique_id,
       CAST((c.c_custkey * 1237) % 200000 AS STRING) AS customer_zip_code_prefix,
       CASE WHEN c.c_custkey % 10 = 0 THEN '  ' ELSE concat(' ', c.c_mktsegment, ' ') END AS customer_city,
       lower(n.n_name) AS customer_state
FROM {customer} c JOIN {nation} n ON c.c_nationkey = n.n_nationkey""",
    "sellers": """
SELECT CAST(s.s_suppkey AS STRING) AS seller_id,
       CAST((s.s_suppkey * 7331) % 200000 AS STRING) AS seller_zip_code_prefix,
       concat(' ', s.s_name, ' ') AS seller_city,
       CASE WHEN s.s_suppkey % 7 = 0 THEN upper(n.n_name) ELSE lower(n.n_name) END AS seller_state
FROM {supplier} s JOIN {nation} n ON s.s_nationkey = n.n_nationkey""",
    "orders": """
SELECT CAST(o_orderkey AS STRING) AS order_id,
       CASE WHEN o_custkey % 139 = 0 THEN concat('gone-', CAST(o_custkey AS STRING))
            ELSE CAST(o_custkey AS STRING) END AS customer_id,
       CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN ' Shipped ' ELSE 'canceled' END AS order_status,
       CASE WHEN o_orderkey % 211 = 0 THEN 'not a date' ELSE CAST(o_orderdate AS STRING) END AS order_purchase_timestamp,
       CAST(o_orderdate AS STRING) AS order_approved_at,
       CASE WHEN o_orderstatus <> 'P' THEN CAST(CAST(o_orderdate AS DATE) + 1 AS STRING) END AS order_delivered_carrier_date,
       CASE WHEN o_orderstatus = 'F' AND o_orderkey % 97 <> 0
            THEN concat(CAST(CAST(o_orderdate AS DATE) + CAST((o_orderkey * 7919) % 45 - 2 AS INT) AS STRING), ' ',
                        lpad(CAST(o_orderkey % 24 AS STRING), 2, '0'), ':15:00') END AS order_delivered_customer_date,
       CASE WHEN o_orderkey % 89 <> 0 THEN CAST(CAST(o_orderdate AS DATE) + 23 AS STRING) END AS order_estimated_delivery_date
FROM {orders}""",
    "order_items": """
SELECT CASE WHEN l_partkey % 167 = 0 THEN concat('lost-', CAST(l_orderkey AS STRING)) WHEN l_partkey % 173 = 0 THEN NULL
            ELSE CAST(l_orderkey AS STRING) END AS order_id,
       CASE WHEN l_partkey % 3 = 0 THEN concat(CAST(l_linenumber AS STRING), '.0')
            ELSE CAST(l_linenumber AS STRING) END AS order_item_id,
       CASE WHEN l_suppkey % 29 = 0 AND l_linenumber = 2 THEN concat('gone-', CAST(l_partkey AS STRING))
            ELSE CAST(l_partkey AS STRING) END AS product_id,
       CASE WHEN l_partkey % 127 = 0 THEN 'none' ELSE CAST(l_suppkey AS STRING) END AS seller_id,
       CAST(l_shipdate AS STRING) AS shipping_limit_date,
       CASE WHEN l_orderkey % 307 = 0 THEN '-1.00'
            WHEN l_orderkey % 311 = 0 THEN CAST(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(40 AS DECIMAL(2,0)) AS DECIMAL(12,2)) AS STRING)
            ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS STRING) END AS price,
       CASE WHEN l_partkey % 113 = 0 THEN '-0.50' ELSE CAST(CAST(CAST(l_tax AS DECIMAL(4,2)) * CAST(l_extendedprice AS DECIMAL(12,2)) AS DECIMAL(12,2)) AS STRING) END AS freight_value
FROM {lineitem}""",
    "order_payments": """
SELECT CASE WHEN l_partkey % 179 = 0 THEN concat('lost-', CAST(l_orderkey AS STRING))
            ELSE CAST(l_orderkey AS STRING) END AS order_id,
       CAST(l_linenumber AS STRING) AS payment_sequential,
       CASE WHEN l_linenumber <= 3 THEN 'credit_card' WHEN l_linenumber = 4 THEN 'boleto'
            WHEN l_linenumber = 5 THEN ' Voucher' WHEN l_linenumber = 6 THEN 'debit_card'
            ELSE 'not_defined' END AS payment_type,
       CAST(l_quantity % 11 AS STRING) AS payment_installments,
       CAST(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(0.004 AS DECIMAL(4,3)) AS DECIMAL(12,2)) AS STRING) AS payment_value
FROM {lineitem}""",
    "order_reviews": """
SELECT concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING), '-', CAST(l_suppkey AS STRING)) AS review_id,
       CAST(l_orderkey AS STRING) AS order_id,
       CAST(l_quantity % 7 AS STRING) AS review_score,
       CASE WHEN l_returnflag = 'R' THEN NULL ELSE concat('comment on line ', CAST(l_linenumber AS STRING)) END AS review_comment_message,
       CAST(CAST(l_shipdate AS DATE) AS STRING) AS review_creation_date,
       CASE WHEN l_linestatus = 'O' AND l_returnflag = 'N' THEN NULL
            ELSE concat(CAST(CAST(l_shipdate AS DATE) + CAST(l_linenumber % 3 AS INT) AS STRING), ' ',
                        lpad(CAST(l_suppkey % 24 AS STRING), 2, '0'), ':30:00') END AS review_answer_timestamp
FROM {lineitem}""",
    "products": """
SELECT CAST(p_partkey AS STRING) AS product_id,
       CASE WHEN p_partkey % 41 = 0 THEN NULL WHEN p_partkey % 43 = 0 THEN '   '
            WHEN p_partkey % 5 = 0 THEN concat(' ', p_brand, ' ') ELSE p_brand END AS product_category_name,
       CAST(length(p_name) AS STRING) AS product_name_lenght,
       concat(CAST(length(p_name) * 3 AS STRING), '.0') AS product_description_lenght,
       CAST(p_size % 6 AS STRING) AS product_photos_qty,
       CASE WHEN p_size % 10 = 0 THEN '0' ELSE CAST(p_size * 37 AS STRING) END AS product_weight_g,
       concat(CAST(p_size AS STRING), '.0') AS product_length_cm,
       concat(CAST(CAST(floor(p_retailprice / 100) AS BIGINT) AS STRING), '.7') AS product_height_cm,
       CAST(p_size + 5 AS STRING) AS product_width_cm
FROM {part}""",
    "geolocation": """
SELECT CAST((c.c_custkey * 1237) % 200000 AS STRING) AS geolocation_zip_code_prefix,
       CASE WHEN c.c_custkey % 13 = 0 THEN 'n/a'
            ELSE CAST(CAST(c.c_acctbal / 250 - 30 AS DECIMAL(10,4)) AS STRING) END AS geolocation_lat,
       CAST(CAST(-40 - c.c_acctbal / 500 AS DECIMAL(10,4)) AS STRING) AS geolocation_lng,
       lower(c.c_mktsegment) AS geolocation_city,
       lower(n.n_name) AS geolocation_state
FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey JOIN {nation} n ON c.c_nationkey = n.n_nationkey""",
}

#: rows that arrive twice, as repeated deliveries do
REPEATED = {"customers": "c.c_custkey % 97 = 0", "sellers": "s.s_suppkey % 33 = 0", "orders": "o_orderkey % 499 = 0",
            "products": "p_partkey % 89 = 0"}
for _table, _again in REPEATED.items():
    LANDING_SQL[_table] += f"\nUNION ALL{LANDING_SQL[_table]}\nWHERE {_again}"

LANDING_INPUTS: dict[str, tuple[str, ...]] = {
    "customers": ("customer", "nation"),
    "sellers": ("supplier", "nation"),
    "orders": ("orders",),
    "order_items": ("lineitem",),
    "order_payments": ("lineitem",),
    "order_reviews": ("lineitem",),
    "products": ("part",),
    "geolocation": ("orders", "customer", "nation"),
}


def translation_rows() -> list[tuple[str, str]]:
    """Category translation lookup for the stand-in categories (the part
    brands): 'Brand#k' -> 'brand number k' for k = 1..25, with brands 13
    and 21 left untranslated and brand 5 listed twice."""
    rows = [(f"Brand#{k}", f"brand number {k}") for k in range(1, 26) if k not in (13, 21)]
    rows.append(("brand#5 ", "brand five"))
    return rows


def _region_names() -> list[str]:
    return ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


def state_region_map() -> dict[str, str]:
    """Stand-in state -> region map over the driver's nations: NATION_k lies
    in region k mod 5 (as in the nation table). Nations 23 and 24 are left
    out so unknown keys are exercised."""
    regions = _region_names()
    return {f"NATION_{k}": regions[k % 5] for k in range(23)}


def landing_table(spark: SparkSession, tables: TableSet, name: str) -> DataFrame:
    if name == "category_translation":
        return spark.createDataFrame(translation_rows(),
                                     "product_category_name string, product_category_name_english string")
    frames = {t: tables[t] for t in LANDING_INPUTS[name]}
    return spark.sql(LANDING_SQL[name], **frames)


LANDING_TABLES = tuple(LANDING_SQL) + ("category_translation",)


def landing(spark: SparkSession, tables: TableSet) -> dict[str, DataFrame]:
    return {name: landing_table(spark, tables, name) for name in LANDING_TABLES}
