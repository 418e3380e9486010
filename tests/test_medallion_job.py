import os

import pytest

from strata.operators.integrity import IntegrityError, check_unique, enforce
from strata.plans.medallion import Medallion
from strata.plans.medallion_job import _checked, conserved, run_medallion
from strata.session import scratch_path
from strata.sources.catalog import describe_dictionary, list_tables, table_comment
from strata.sources.csv_text import write_text_csv
from strata.sources.landing import LANDING_TABLES


def test_end_to_end_job(spark, small_dir):
    out = run_medallion(spark, scratch_path(spark, "job"), landed=Medallion(spark, small_dir).bronze, prefix="t_")
    summary = {r.table: r.rows for r in out["summary"].collect()}
    assert summary["silver.orders"] == 1500 and summary["gold.fact_order_items"] > 0
    gold_tables = {r.tableName for r in list_tables(spark, "t_gold").collect()}
    assert {"fact_order_items", "dim_date", "report_revenue_by_category", "report_payment_mix"} <= gold_tables
    assert spark.table("t_bronze.dq_rules").count() == 23
    assert spark.table("t_silver.integrity").filter("severity = 'error' AND violations > 0").count() == 0
    assert table_comment(spark, "t_gold.dim_customer").startswith("One row for a customer")
    assert describe_dictionary(spark, "t_gold", ["fact_payments"]).filter("comment IS NULL").count() == 0
    assert spark.table("t_gold.report_revenue_by_category").count() == 10
    assert spark.table("t_gold.measure_summary").count() == 5 and out["bronze.dq_distribution"].count() == 4


def _landing(spark, small_dir):
    root = scratch_path(spark, "job-landing")
    for t, df in Medallion(spark, small_dir).bronze.items():
        write_text_csv(df, os.path.join(root, f"{t}.csv"), files=2)
    return root, {t: f"{t}.csv" for t in LANDING_TABLES}


def test_job_from_csv_files(spark, small_dir):
    root, manifest = _landing(spark, small_dir)
    out = run_medallion(spark, scratch_path(spark, "job-csv"), landing_dir=root, manifest=manifest, prefix="tc_",
                        spread_hot=True)
    assert "_source_file" in out["bronze.orders"].columns
    assert {r.source for r in out["summary"].filter("table LIKE 'bronze.%'").collect()} == set(manifest.values())
    same = run_medallion(spark, scratch_path(spark, "job-frames"), landed=Medallion(spark, small_dir).bronze, prefix="tf_")
    for t in ("bronze.dq_rules", "silver.integrity", "gold.fact_order_items", "gold.report_delivery_by_state"):
        assert sorted(map(str, out[t].collect())) == sorted(map(str, same[t].collect())), t
    assert all(r.occurrences > 0 for r in out["bronze.dq_rules"].collect())
    with pytest.raises(FileNotFoundError, match="nothing.csv"):
        run_medallion(spark, scratch_path(spark, "job-none"), landing_dir=root, manifest=manifest | {"orders": "nothing.csv"})


def test_job_stops_on_repeated_keys(spark):
    report = check_unique(spark.createDataFrame([(1,), (1,)], "k int"), ["k"], "t")
    with pytest.raises(IntegrityError, match="1 violations"):
        enforce(report)
    orders = spark.createDataFrame([("a",)], "order_id string")
    items = spark.createDataFrame([("a", 1), ("a", 2), ("lost", 1)], "order_id string, order_item_id int")
    fact = spark.createDataFrame([("a", 1), ("a", 1)], "order_id string, item_id int")
    with pytest.raises(IntegrityError, match="not conserved"):
        _checked(conserved(items, orders, fact))


def _moved(df):
    """Shuffles by a key in the plan of ``df``."""
    return df._jdf.queryExecution().executedPlan().toString().count("hashpartitioning")


def test_order_tables_meet_without_a_shuffle(spark, small_dir, monkeypatch):
    from strata.plans import analyses, medallion_job
    monkeypatch.setattr(medallion_job, "BUCKET_ROWS", 2000)
    landed = Medallion(spark, small_dir).bronze
    before = spark.conf.get("spark.sql.shuffle.partitions")
    run = medallion_job.run_medallion
    out = run(spark, scratch_path(spark, "job-buckets"), landed=landed, prefix="tb_")
    plain = run(spark, scratch_path(spark, "job-plain"), landed=landed, prefix="tp_", spread_hot=True)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    for t in ("silver.integrity", "silver.order_reviews", "gold.fact_order_items", "gold.fact_payments", "gold.domain_report",
              "gold.quarantine_fact_order_items", "gold.measure_summary", "gold.report_monthly_top_categories"):
        drop = [c for c in out[t].columns if c == "_silver_ts"]
        assert sorted(map(str, out[t].drop(*drop).collect())) == sorted(map(str, plain[t].drop(*drop).collect())), t
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        items, orders, fact = (spark.table(f"tb_{t}") for t in ("silver.order_items", "silver.orders", "gold.fact_order_items"))
        assert len(items.inputFiles()) == 3  # one a bucket
        assert _moved(check_unique(items, ["order_id", "order_item_id"], "t")) == 0
        assert _moved(items.join(orders, "order_id")) == 0
        assert _moved(analyses.instalments_by_value_band(spark.table("tb_gold.fact_payments"))) <= 1
        with medallion_job._setting(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false"):
            assert _moved(conserved(items, orders, fact)) == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
