"""Registered queries: one callable (spark, data_dir) -> DataFrame per
operator or report. Each reads the whole driver tables through the
landing -> silver -> gold chain, so its work grows with the data."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.columns import (clean_text, lower_text, map_lookup, null_nonpositive,
                                pad_code, to_decimal, to_int, to_timestamp, upper_text)
from .operators.dedup import dedup
from .operators.domains import broken_references, domain_report, quarantine
from .operators.integrity import check_orphans, check_unique, integrity_report, row_conservation
from .operators.profile import column_profile, numeric_distribution, numeric_summary
from .operators.quality import (duplicate_keys, duplicate_surplus_modes, iqr_report, missing_reference,
                               run_rules)
from .plans import analyses as A
from .plans import silver as S
from .plans.dictionary import GOLD_DICTIONARY
from .plans.medallion import GOLD_TABLES, Medallion, checked_gold
from .plans.quality_rules import landing_rules
from .plans.specs import gold_domains
from .session import ensure_checkpoint_dir, scratch_path, written
from .sources.catalog import (apply_dictionary, create_schema, describe_dictionary, drop_schema, overwrite_table,
                              table_comment, table_location)
from .sources.csv_text import PROVENANCE, read_text_csv, row_counts, source_name, write_text_csv
from .sources.landing import LANDING_TABLES

Query = Callable[[SparkSession, str], DataFrame]


def _m(spark: SparkSession, d: str) -> Medallion:
    return Medallion(spark, d)


def _own(name: str) -> str:
    """A catalogue name that no other run uses."""
    return f"strata_{name}_{uuid.uuid4().hex[:12]}"


# ---------------------------------------------------------------- reports

def revenue_by_category(spark, d):
    g = _m(spark, d).gold
    return A.revenue_by_category(g["fact_order_items"], g["dim_product"])


def monthly_top_categories(spark, d):
    g = _m(spark, d).gold
    return A.monthly_top_categories(g["fact_order_items"], g["dim_product"], g["dim_date"])


def delay_vs_score(spark, d):
    return A.delay_vs_score(_m(spark, d).gold["fact_order_items"])


def delay_score_corr(spark, d):
    return A.delay_score_corr(_m(spark, d).gold["fact_order_items"])


def delivery_by_state(spark, d):
    g = _m(spark, d).gold
    return A.delivery_by_state(g["fact_order_items"], g["dim_customer"])


def payment_mix(spark, d):
    return A.payment_mix(_m(spark, d).gold["fact_payments"])


def instalments_by_value_band(spark, d):
    return A.instalments_by_value_band(_m(spark, d).gold["fact_payments"])


def domain_frequency(spark, d):
    b = _m(spark, d).bronze
    return A.domain_frequency(b["orders"], b["order_payments"], b["customers"])


# ---------------------------------------------------------------- column builders

def clean_text_q(spark, d):
    b = _m(spark, d).bronze["customers"]
    return b.select(F.col("customer_id").alias("raw_id"), clean_text("customer_id").alias("customer_id"),
                    clean_text("customer_city").alias("city_clean"), lower_text("customer_city").alias("city_lower"),
                    upper_text("customer_state").alias("state_upper"))


def clean_zip(spark, d):
    b = _m(spark, d).bronze["customers"]
    return b.select(clean_text("customer_id").alias("customer_id"),
                    F.col("customer_zip_code_prefix").alias("zip_raw"),
                    pad_code("customer_zip_code_prefix").alias("zip_prefix"))


def typed_cast(spark, d):
    b = _m(spark, d).bronze["order_items"]
    return b.select("order_id", F.col("order_item_id").alias("item_raw"),
                    to_int("order_item_id").alias("item_id"),
                    to_decimal("price").alias("price"), to_decimal("freight_value").alias("freight_value"),
                    to_timestamp("shipping_limit_date").alias("shipping_limit"))


def map_lookup_q(spark, d):
    m = _m(spark, d)
    b = m.bronze["sellers"]
    state = upper_text("seller_state")
    return b.select(clean_text("seller_id").alias("seller_id"), state.alias("state"),
                    map_lookup(state, m.region_map).alias("region"))


def clamp_min_q(spark, d):
    return _m(spark, d).silver["order_payments"]


def null_nonpositive_q(spark, d):
    b = _m(spark, d).bronze["products"]
    w = to_int("product_weight_g")
    return b.select(clean_text("product_id").alias("product_id"), w.alias("weight_raw"),
                    null_nonpositive(w).alias("weight_g"))


def null_inconsistent_date(spark, d):
    return _m(spark, d).silver["orders"]


def enrich_category(spark, d):
    return _m(spark, d).silver["products"]


# ---------------------------------------------------------------- dedup

def dedup_key(spark, d):
    """The most expensive item of every order (ties: total order)."""
    items = _m(spark, d).silver["order_items"]
    return dedup(items, ["order_id"], [F.col("price").desc_nulls_last()], require_keys=True)


def dedup_composite(spark, d):
    return _m(spark, d).silver["order_items"]


def latest_per_key(spark, d):
    return _m(spark, d).silver["order_reviews"]


def silver_customers(spark, d):
    return _m(spark, d).silver["customers"]


def silver_sellers(spark, d):
    return _m(spark, d).silver["sellers"]


# ---------------------------------------------------------------- uniqueness and integrity

_SURPLUS_SPECS = [
    ("orders", ("order_id",)),
    ("customers", ("customer_id",)),
    ("products", ("product_id",)),
    ("sellers", ("seller_id",)),
    ("order_items", ("order_id", "order_item_id")),
    ("geolocation", ("geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng",
                     "geolocation_city", "geolocation_state")),
]


def duplicate_surplus_q(spark, d):
    b = _m(spark, d).bronze
    out = None
    for table, keys in _SURPLUS_SPECS:
        one = duplicate_surplus_modes(b[table], keys).select(
            F.lit(table).alias("table"), F.lit(",".join(keys)).alias("keys"),
            "null_safe", "rows", "distinct_keys", "surplus")
        out = one if out is None else out.unionByName(one)
    return out


def duplicate_keys_q(spark, d):
    b = _m(spark, d).bronze
    return duplicate_keys(b["order_reviews"], ["order_id"]).select(
        F.lit("order_reviews").alias("table"), "keys_with_duplicates") \
        .unionByName(duplicate_keys(b["order_items"], ["order_id", "order_item_id"]).select(
            F.lit("order_items").alias("table"), "keys_with_duplicates"))


_UNIQUE_SPECS = [
    ("customers", ["customer_id"]), ("sellers", ["seller_id"]), ("orders", ["order_id"]),
    ("order_items", ["order_id", "order_item_id"]), ("order_payments", ["order_id", "payment_sequential"]),
    ("order_reviews", ["order_id"]), ("products", ["product_id"]),
]
_ORPHAN_SPECS = [
    ("order_items", "orders", "order_id"), ("order_items", "products", "product_id"),
    ("order_items", "sellers", "seller_id"), ("orders", "customers", "customer_id"),
    ("order_payments", "orders", "order_id"),
]


def check_unique_q(spark, d):
    """Repeated keys before cleaning (reported) and after it (errors)."""
    m = _m(spark, d)
    return integrity_report([check_unique(m.silver[t], k, t) for t, k in _UNIQUE_SPECS]
                            + [check_unique(m.bronze[t], k, f"bronze.{t}", "warn") for t, k in _UNIQUE_SPECS])


def check_orphans_q(spark, d):
    s = _m(spark, d).silver
    return integrity_report([check_orphans(s[c], s[p], k, c, p) for c, p, k in _ORPHAN_SPECS])


def integrity_report_q(spark, d):
    s = _m(spark, d).silver
    checks = [check_unique(s[t], k, t) for t, k in _UNIQUE_SPECS]
    checks += [check_orphans(s[c], s[p], k, c, p) for c, p, k in _ORPHAN_SPECS]
    return integrity_report(checks)


def row_conservation_q(spark, d):
    m = _m(spark, d)
    return row_conservation(m.silver["order_items"],
                            m.gold["fact_order_items"].withColumnRenamed("item_id", "order_item_id"),
                            ["order_id", "order_item_id"])


# ---------------------------------------------------------------- star schema

def dim_customer(spark, d):
    return _m(spark, d).gold["dim_customer"]


def dim_supplier(spark, d):
    return _m(spark, d).gold["dim_seller"]


def dim_product(spark, d):
    return _m(spark, d).gold["dim_product"]


def dim_date(spark, d):
    return _m(spark, d).gold["dim_date"]


def fact_items(spark, d):
    return _m(spark, d).gold["fact_order_items"]


def fact_payments(spark, d):
    return _m(spark, d).gold["fact_payments"]


# ---------------------------------------------------------------- profiling and quality

def column_profile_q(spark, d):
    return column_profile(_m(spark, d).bronze, exact=True)


def column_profile_approx(spark, d):
    """The default profile beside the exact one: whether each approximate
    distinct count is within 8 % (or 2 values) of the exact count."""
    b = _m(spark, d).bronze
    near, exact = column_profile(b), column_profile(b, exact=True)
    exact = exact.select("table", "column", F.col("distinct_values").alias("__exact"))
    off = F.abs(F.col("distinct_values") - F.col("__exact"))
    return near.join(exact, ["table", "column"]).select(
        "table", "column", "total_rows", "null_or_blank", "pct_null",
        (off <= F.greatest(F.lit(2.0), F.lit(0.08) * F.col("__exact"))).alias("distinct_within_bound"))


def numeric_distribution_q(spark, d):
    b = _m(spark, d).bronze
    return numeric_distribution([("price", b["order_items"], "price"),
                                 ("freight_value", b["order_items"], "freight_value"),
                                 ("payment_value", b["order_payments"], "payment_value"),
                                 ("review_score", b["order_reviews"], "review_score")])


def numeric_summary_q(spark, d):
    f = _m(spark, d).gold["fact_order_items"]
    return numeric_summary(f, ["lead_time_days", "delay_days", "item_price", "freight_value", "review_score"])


def iqr_outliers_q(spark, d):
    m = _m(spark, d)
    b, t = m.bronze, m.tables
    parts = [("order_items", b["order_items"], ["price", "freight_value"]),
             ("order_payments", b["order_payments"], ["payment_value"]), ("events", t["events"], ["value"])]
    out = None
    for table, df, cols in parts:
        one = iqr_report(df, cols).select(F.lit(table).alias("table"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def dq_checks(spark, d):
    return run_rules(_m(spark, d).bronze, landing_rules())


def dq_untranslated(spark, d):
    m = _m(spark, d)
    raw = missing_reference(m.bronze["products"], "product_category_name",
                            m.bronze["category_translation"], "product_category_name")
    clean = missing_reference(m.silver["products"], "product_category_name",
                              m.silver["category_translation"], "product_category_name")
    return raw.select(F.lit("landing").alias("layer"), "missing") \
              .unionByName(clean.select(F.lit("silver").alias("layer"), "missing"))


def dictionary_domains(spark, d):
    """The value domains of the data dictionary, counted over the gold tables."""
    m = _m(spark, d)
    return domain_report(m.gold, gold_domains(m.region_map))


def domain_quarantine(spark, d):
    """Rows of each gold table that break a domain, by the columns that do. The
    columns with domains are written first, then the keys that parents lack;
    the rows meet these keys alone."""
    m = _m(spark, d)
    domains = gold_domains(m.region_map)
    gold = checked_gold(m, {t: list(of) for t, of in domains.items()})
    broken = written(broken_references(gold, domains), "broken-references")
    out = None
    for table, of in domains.items():
        one = quarantine(gold[table], of, gold, broken=broken, table=table).groupBy(
            F.lit(table).alias("table"), F.array_join("_violations", ",").alias("violations")).agg(
            F.count(F.lit(1)).alias("rows"))
        out = one if out is None else out.unionByName(one)
    return out


# ---------------------------------------------------------------- sources and sinks

def load_summary(spark, d):
    return row_counts(_m(spark, d).bronze)


def src_csv_roundtrip(spark, d):
    """Landing orders written as CSV text, read back text-first, then typed:
    must equal the silver orders built straight from the landing data."""
    path = scratch_path(spark, "csv-orders")
    write_text_csv(_m(spark, d).bronze["orders"], path)
    raw = read_text_csv(spark, path).drop(PROVENANCE, "_ingestion_ts")
    return S.build("orders", {"orders": raw}, {})


def src_provenance(spark, d):
    """Rows per landing folder, counted from the provenance column."""
    b = _m(spark, d).bronze
    root = scratch_path(spark, "csv-landing")
    out = None
    for table in LANDING_TABLES:
        write_text_csv(b[table], os.path.join(root, table))
        df = read_text_csv(spark, os.path.join(root, table))
        one = df.groupBy(source_name().alias("source")).agg(F.count(F.lit(1)).alias("rows"))
        out = one if out is None else out.unionByName(one)
    return out


def stream_ingest(spark, d):
    """Landing orders arrive as CSV files in two waves; each wave is loaded
    by an incremental streaming run (file source -> parquet sink with a
    checkpoint). The loaded rows, typed, must equal the silver orders."""
    from .streaming.ingest import ingest_available

    orders = _m(spark, d).bronze["orders"]
    root = scratch_path(spark, "stream-orders")
    landing, target, ckpt = (os.path.join(root, p) for p in ("landing", "table", "checkpoint"))
    delivered = F.coalesce(F.col("order_status") == "delivered", F.lit(False))
    first, rest = orders.filter(delivered), orders.filter(~delivered)
    write_text_csv(first, os.path.join(landing, "wave=1"))
    ingest_available(spark, landing, target, ckpt, columns=orders.columns)
    write_text_csv(rest, os.path.join(landing, "wave=2"))
    ingest_available(spark, landing, target, ckpt, columns=orders.columns)
    raw = spark.read.parquet(target).drop(PROVENANCE, "_ingestion_ts")
    return S.build("orders", {"orders": raw.select(*orders.columns)}, {})


def _run(spark, **inputs) -> dict[str, DataFrame]:
    """The whole job under catalogue names of its own, which go afterwards."""
    from .plans.medallion_job import LAYER_COMMENTS, run_medallion

    prefix = _own("run") + "_"
    try:
        return run_medallion(spark, scratch_path(spark, "medallion-run"), prefix=prefix, **inputs)
    finally:
        for layer in LAYER_COMMENTS:
            drop_schema(spark, prefix + layer)


def medallion_run(spark, d):
    """The whole job as documented catalogue tables (landing, DQ, silver,
    integrity enforcement, gold, dictionary, reports); returns the load
    summary (table, rows) of every layer table."""
    return _run(spark, landed=_m(spark, d).bronze)["summary"].select("table", "rows")


def medallion_csv(spark, d):
    """The job from CSV files alone: the nine landing tables are written as
    CSV, the job reads them back by its manifest, and what it wrote is
    returned: rules, integrity checks, domains and the revenue report."""
    landing = scratch_path(spark, "medallion-landing")
    for t, df in _m(spark, d).bronze.items():
        write_text_csv(df, os.path.join(landing, f"{t}.csv"))
    out = _run(spark, landing_dir=landing, manifest={t: f"{t}.csv" for t in LANDING_TABLES})
    parts = [out["bronze.dq_rules"].selectExpr("'rule' AS part", "`table` AS item", "check AS name", "occurrences AS n"),
             out["silver.integrity"].selectExpr("'integrity' AS part", "`table` AS item", "check AS name", "violations AS n"),
             out["bronze.dq_domains"].selectExpr("'domain' AS part", "domain AS item", "value AS name", "n"),
             out["gold.report_revenue_by_category"].selectExpr("'revenue' AS part", "category AS item",
                                                               "CAST(revenue AS STRING) AS name", "orders AS n"),
             out["summary"].selectExpr("'source' AS part", "table AS item", "source AS name", "rows AS n")]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return rows


def sink_overwrite(spark, d):
    """Overwrite a table with a different schema, re-apply its comment and
    read it back."""
    ensure_checkpoint_dir(spark)
    sellers = _m(spark, d).silver["sellers"]
    loc = scratch_path(spark, "sink-sellers")
    name = _own("sink_sellers")
    try:
        overwrite_table(sellers.select("seller_id"), name, loc, "first version")
        overwrite_table(sellers, name, loc, "silver sellers, cleaned and deduplicated")
        assert table_comment(spark, name) == "silver sellers, cleaned and deduplicated"
        return spark.read.parquet(table_location(spark, name))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def catalog_dictionary(spark, d):
    """Write the gold tables into a documented schema and list the data
    dictionary (table, position, column, type, comment with lineage)."""
    m = _m(spark, d)
    root, schema = scratch_path(spark, "gold-schema"), _own("gold")
    create_schema(spark, schema, "Gold layer: star schema ready for analysis", os.path.join(root, "schema"))
    try:
        for t in GOLD_TABLES:
            overwrite_table(m.gold[t], f"{schema}.{t}", os.path.join(root, t))
        apply_dictionary(spark, schema, GOLD_DICTIONARY)
        return describe_dictionary(spark, schema, list(GOLD_TABLES))
    finally:
        drop_schema(spark, schema)


QUERIES: dict[str, Query] = {
    "revenue_by_category": revenue_by_category,
    "monthly_top_categories": monthly_top_categories,
    "delay_vs_score": delay_vs_score,
    "delay_score_corr": delay_score_corr,
    "delivery_by_state": delivery_by_state,
    "payment_mix": payment_mix,
    "instalments_by_value_band": instalments_by_value_band,
    "domain_frequency": domain_frequency,
    "clean_text": clean_text_q,
    "clean_zip": clean_zip,
    "typed_cast": typed_cast,
    "map_lookup": map_lookup_q,
    "clamp_min": clamp_min_q,
    "null_nonpositive": null_nonpositive_q,
    "null_inconsistent_date": null_inconsistent_date,
    "enrich_category": enrich_category,
    "dedup_key": dedup_key,
    "dedup_composite": dedup_composite,
    "latest_per_key": latest_per_key,
    "duplicate_surplus": duplicate_surplus_q,
    "duplicate_keys": duplicate_keys_q,
    "check_unique": check_unique_q,
    "check_orphans": check_orphans_q,
    "integrity_report": integrity_report_q,
    "row_conservation": row_conservation_q,
    "dim_customer": dim_customer,
    "dim_supplier": dim_supplier,
    "dim_product": dim_product,
    "dim_date": dim_date,
    "fact_items": fact_items,
    "fact_payments": fact_payments,
    "silver_customers": silver_customers,
    "silver_sellers": silver_sellers,
    "column_profile": column_profile_q,
    "column_profile_approx": column_profile_approx,
    "numeric_distribution": numeric_distribution_q,
    "numeric_summary": numeric_summary_q,
    "iqr_outliers": iqr_outliers_q,
    "dq_checks": dq_checks,
    "dq_untranslated": dq_untranslated,
    "dictionary_domains": dictionary_domains,
    "domain_quarantine": domain_quarantine,
    "load_summary": load_summary,
    "src_csv_roundtrip": src_csv_roundtrip,
    "src_provenance": src_provenance,
    "stream_ingest": stream_ingest,
    "medallion_run": medallion_run,
    "medallion_csv": medallion_csv,
    "sink_overwrite": sink_overwrite,
    "catalog_dictionary": catalog_dictionary,
}
