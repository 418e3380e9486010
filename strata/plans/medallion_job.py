"""The whole run as catalogue tables.

1. schemas for the layers (with comments and locations);
2. landing tables, from CSV files named by a manifest or from given frames,
   with the quality rules, profile, distributions and domains over them;
3. silver tables (with the audit column) and the integrity checks: repeated
   keys fail the job, orphans are reported;
4. gold tables with the data dictionary, the measure summary and the row
   conservation check (fails when items of known orders are lost or doubled);
5. the value domains of the dictionary, counted, with the offending rows of
   each gold table in a quarantine table, and the business reports.

Every table is written below ``root`` (a shared folder) and registered in the
session catalogue; the tables of a layer are written side by side. Each layer
is built from the written copy of the one before, so a lost executor restarts
from the last written layer.

The tables that meet by order are written in buckets of the order, so a row of
theirs is shuffled once, when its silver table is made; the checks, the facts
and the reports by order that follow read the buckets. ``spread_hot`` is for
orders that would be too large for one task: these tables are then written
without buckets and joined with the large orders salted.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.domains import broken_references, domain_report, quarantine
from ..operators.integrity import (IntegrityError, check_orphans, check_unique, enforce, integrity_report,
                                   row_conservation)
from ..operators.profile import column_profile, numeric_distribution, numeric_summary
from ..operators.quality import run_rules
from ..session import setting as _setting
from ..sources.catalog import apply_dictionary, create_schema, overwrite_table, table_location
from ..sources.csv_text import LOADED_AT, PROVENANCE, read_manifest, row_counts
from ..sources.landing import LANDING_TABLES
from . import analyses as A
from .dictionary import GOLD_DICTIONARY
from .medallion import AUDIT_COLUMN, BUCKET_ROWS, GOLD_TABLES, SILVER_TABLES, Medallion, buckets_for
from .quality_rules import landing_rules
from .silver import BUCKET_BY
from .silver import BUCKETED as SILVER_BUCKETED
from .specs import SILVER, gold_domains

UNIQUE_KEYS = {t: list(s.key) for t, s in SILVER.items() if t != "category_translation"}
FOREIGN_KEYS = [("order_items", "orders", "order_id"), ("order_items", "products", "product_id"),
                ("order_items", "sellers", "seller_id"), ("orders", "customers", "customer_id"),
                ("order_payments", "orders", "order_id")]
LAYER_COMMENTS = {
    "bronze": "Landing data as delivered, all columns as text, with load metadata",
    "silver": "Cleaned, typed and deduplicated tables",
    "gold": "Star schema (facts and dimensions) and reports",
}
BUCKETED = {*SILVER_BUCKETED, "fact_order_items", "fact_payments"}
MEASURES = ["lead_time_days", "delay_days", "item_price", "freight_value", "review_score"]
DISTRIBUTIONS = [("order_items", "price"), ("order_items", "freight_value"), ("order_payments", "payment_value"),
                 ("order_reviews", "review_score")]


def conserved(items: DataFrame, orders: DataFrame, fact: DataFrame) -> DataFrame:
    """Row conservation of the item fact against the items of known orders."""
    known = items.join(orders.select("order_id"), "order_id", "left_semi")
    return row_conservation(known, fact.withColumnRenamed("item_id", "order_item_id"), ["order_id", "order_item_id"],
                            never_null=["order_id"])  # known items have one


def _checked(cons: DataFrame) -> None:
    bad = cons.filter((F.col("missing") > 0) | (F.col("extra") > 0)).collect()  # one row
    if bad:
        raise IntegrityError(f"order items not conserved between silver and gold: {bad[0].asDict()}")


def reports(gold: Mapping[str, DataFrame], months: tuple[str, str]) -> dict[str, DataFrame]:
    fact, pay = gold["fact_order_items"], gold["fact_payments"]
    return {
        "revenue_by_category": A.revenue_by_category(fact, gold["dim_product"]),
        "monthly_top_categories": A.monthly_top_categories(fact, gold["dim_product"], gold["dim_date"],
                                                           start=months[0], end=months[1]),
        "delay_vs_score": A.delay_vs_score(fact),
        "delay_score_corr": A.delay_score_corr(fact),
        "delivery_by_state": A.delivery_by_state(fact, gold["dim_customer"]),
        "payment_mix": A.payment_mix(pay),
        "instalments_by_value_band": A.instalments_by_value_band(pay),
    }


def run_medallion(spark: SparkSession, root: str, landed: Mapping[str, DataFrame] | None = None,
                  landing_dir: str | None = None, manifest: Mapping[str, str] | None = None, prefix: str = "",
                  region_map: Mapping[str, str] | None = None, months: tuple[str, str] = ("1996-01-01", "1999-12-31"),
                  spread_hot: bool = False, parallel: int = 4) -> dict[str, DataFrame]:
    """Run the job over the frames ``landed`` or the CSV files that
    ``manifest`` (table -> file) names in ``landing_dir``; a file that is
    absent stops it before anything is written. Returns the written tables by
    ``layer.table``, and ``summary`` (table, rows, source)."""
    if landed is None:
        landed = read_manifest(spark, landing_dir, manifest)
    sources = {f"bronze.{t}": f for t, f in (manifest or {}).items()}
    for layer, comment in LAYER_COMMENTS.items():
        create_schema(spark, prefix + layer, comment, os.path.join(root, "schemas", layer))
    out: dict[str, DataFrame] = {}
    bucketed: dict[str, DataFrame] = {}
    buckets = None

    def save(layer: str, frames: Mapping[str, DataFrame], note: Callable[[str], str] | None = None) -> None:
        """The tables of one step, written side by side."""
        def one(name: str) -> tuple[str, DataFrame]:
            table, dealt = f"{prefix}{layer}.{name}", buckets if name in BUCKETED else None
            made = overwrite_table(frames[name], table, os.path.join(root, layer, name), note(name) if note else None,
                                   buckets=dealt, bucket_by=[BUCKET_BY])
            if dealt:
                bucketed[f"{layer}.{name}"] = made
            # by the version just written, so that what is read later can't change
            return f"{layer}.{name}", spark.read.parquet(table_location(spark, table))
        with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
            out.update(pool.map(one, list(frames)))

    def written(layer: str, names, *without: str) -> dict[str, DataFrame]:
        return {n: bucketed.get(f"{layer}.{n}", out[f"{layer}.{n}"]).drop(*without) for n in names}

    def stamped(df: DataFrame) -> DataFrame:
        return df if LOADED_AT in df.columns else df.withColumn(LOADED_AT, F.current_timestamp())

    save("bronze", {n: stamped(landed[n]) for n in LANDING_TABLES}, lambda n: f"Landing copy of {n}, all columns as text")
    bronze = written("bronze", LANDING_TABLES, LOADED_AT, PROVENANCE)
    save("bronze", {
        "dq_rules": run_rules(bronze, landing_rules()), "dq_profile": column_profile(bronze),
        "dq_distribution": numeric_distribution([(c, bronze[t], c) for t, c in DISTRIBUTIONS]),
        "dq_domains": A.domain_frequency(bronze["orders"], bronze["order_payments"], bronze["customers"])})

    if not spread_hot:
        buckets = buckets_for(bronze, BUCKET_ROWS)
    m = Medallion(spark, region_map=region_map, bronze=bronze, buckets=buckets)
    with _setting(spark, "spark.sql.shuffle.partitions", str(buckets) if buckets else None):
        save("silver", {n: m.silver[n].withColumn(AUDIT_COLUMN, F.current_timestamp()) for n in SILVER_TABLES},
             lambda n: f"Silver {n}: cleaned, typed, deduplicated")
    silver = written("silver", SILVER_TABLES, AUDIT_COLUMN)
    save("silver", {"integrity": integrity_report(
        [check_unique(silver[t], k, t) for t, k in UNIQUE_KEYS.items()]
        + [check_orphans(silver[c], silver[p], k, c, p) for c, p, k in FOREIGN_KEYS])})
    enforce(out["silver.integrity"])

    m = Medallion(spark, region_map=region_map, bronze=bronze, silver=silver, spread_hot=spread_hot)
    save("gold", {n: m.gold[n] for n in GOLD_TABLES})
    gold = written("gold", GOLD_TABLES)
    apply_dictionary(spark, f"{prefix}gold", GOLD_DICTIONARY)
    with _setting(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false"):  # buckets of order_id will do
        _checked(conserved(silver["order_items"], silver["orders"], gold["fact_order_items"]))
    domains = gold_domains(m.region_map)
    save("gold", {"broken_references": broken_references(gold, domains)})
    broken = out["gold.broken_references"]
    save("gold", {f"report_{n}": df for n, df in reports(gold, months).items()}
         | {"measure_summary": numeric_summary(gold["fact_order_items"], MEASURES),
            "domain_report": domain_report(gold, domains, broken)}
         | {f"quarantine_{t}": quarantine(gold[t], of, gold, broken=broken, table=t) for t, of in domains.items()})

    layers = [("bronze", LANDING_TABLES), ("silver", SILVER_TABLES), ("gold", GOLD_TABLES)]
    out["summary"] = row_counts({f"{layer}.{n}": out[f"{layer}.{n}"] for layer, names in layers for n in names}, sources)
    return out


def main(argv: list[str] | None = None) -> None:
    """spark-submit entry: ``python -m strata.plans.medallion_job LANDING_DIR OUT_DIR [SCHEMA_PREFIX]``
    loads ``<table>.csv`` of each landing table, with the Brazilian regions."""
    import sys

    from ..session import build_session
    from .gold import BRAZIL_STATE_REGION

    args = list(sys.argv[1:] if argv is None else argv)
    if len(args) < 2:
        raise SystemExit("usage: medallion_job LANDING_DIR OUT_DIR [SCHEMA_PREFIX]")
    spark = build_session(app_name="strata-medallion")
    out = run_medallion(spark, args[1], landing_dir=args[0], manifest={t: f"{t}.csv" for t in LANDING_TABLES},
                        prefix=args[2] if len(args) > 2 else "", region_map=BRAZIL_STATE_REGION,
                        months=("2017-01-01", "2018-08-31"))
    out["summary"].show(100, truncate=False)


if __name__ == "__main__":
    main()
