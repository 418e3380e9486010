"""Benchmark: the pipeline and its headline reports at $BENCH_SF_DIR on
local[$BENCH_CPUS]; prints one JSON line.

Timed steps, as the pipeline runs in production:
* ``build_silver_gold``: landing -> silver -> gold, both layers written as
  parquet to the shared checkpoint folder (the lineage cut);
* each report over the written gold tables;
* the data-quality rules and column profile over the landing tables.
Every report is fully executed with the ``noop`` sink, so the time covers
the whole plan without pulling results to the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

REPORTS = ["revenue_by_category", "monthly_top_categories", "delay_vs_score", "delay_score_corr",
           "delivery_by_state", "payment_mix", "instalments_by_value_band", "numeric_summary",
           "row_conservation", "integrity_report"]
LANDING = ["dq_checks", "column_profile", "numeric_distribution", "domain_frequency"]


def run(spark, sf_dir, timings=None):
    from strata.operators.integrity import check_orphans, check_unique, integrity_report, row_conservation
    from strata.operators.profile import column_profile, numeric_distribution, numeric_summary
    from strata.operators.quality import run_rules
    from strata.plans import analyses as A
    from strata.plans.medallion import Medallion
    from strata.plans.quality_rules import landing_rules
    from strata.session import scratch_path

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        if out is not None:
            out.write.format("noop").mode("overwrite").save()
        if timings is not None:
            timings[name] = round(time.perf_counter() - t0, 3)

    holder = {}
    timed("build_silver_gold",
          lambda: holder.setdefault("m", Medallion(spark, sf_dir).materialize(scratch_path(spark, "bench"))) and None)
    m = holder["m"]
    g, s, b = m.gold, m.silver, m.bronze
    fact, pay = g["fact_order_items"], g["fact_payments"]
    reports = {
        "revenue_by_category": lambda: A.revenue_by_category(fact, g["dim_product"]),
        "monthly_top_categories": lambda: A.monthly_top_categories(fact, g["dim_product"], g["dim_date"]),
        "delay_vs_score": lambda: A.delay_vs_score(fact),
        "delay_score_corr": lambda: A.delay_score_corr(fact),
        "delivery_by_state": lambda: A.delivery_by_state(fact, g["dim_customer"]),
        "payment_mix": lambda: A.payment_mix(pay),
        "instalments_by_value_band": lambda: A.instalments_by_value_band(pay),
        "numeric_summary": lambda: numeric_summary(fact, ["lead_time_days", "delay_days", "item_price",
                                                          "freight_value", "review_score"]),
        "row_conservation": lambda: row_conservation(s["order_items"],
                                                     fact.withColumnRenamed("item_id", "order_item_id"),
                                                     ["order_id", "order_item_id"]),
        "integrity_report": lambda: integrity_report(
            [check_unique(s["order_items"], ["order_id", "order_item_id"], "order_items"),
             check_unique(s["orders"], ["order_id"], "orders"),
             check_orphans(s["order_items"], s["orders"], "order_id", "order_items", "orders"),
             check_orphans(s["order_items"], s["products"], "product_id", "order_items", "products")]),
        "dq_checks": lambda: run_rules(b, landing_rules()),
        "column_profile": lambda: column_profile(dict(b)),
        "numeric_distribution": lambda: numeric_distribution(
            [("price", b["order_items"], "price"), ("freight_value", b["order_items"], "freight_value"),
             ("payment_value", b["order_payments"], "payment_value"),
             ("review_score", b["order_reviews"], "review_score")]),
        "domain_frequency": lambda: A.domain_frequency(b["orders"], b["order_payments"], b["customers"]),
    }
    for name in REPORTS + LANDING:
        timed(name, reports[name])


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from strata.session import build_session

    spark = build_session(f"local[{cpus}]", shuffle_partitions=2 * cpus,
                          extra={"spark.driver.memory": "16g"})
    # warm-up (JIT, class loading) on the smallest data set, not timed
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm):
        run(spark, warm)
    times: dict[str, float] = {}
    run(spark, sf_dir, times)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "pipeline_plus_reports_time", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
