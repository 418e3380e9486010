"""Plan-shape checks: the properties the design relies on at scale."""

import re

import pytest

import __spark_entry__ as E
from strata.plans import analyses as A
from strata.plans.medallion import Medallion
from strata.queries import QUERIES
from strata.session import scratch_path

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")
# keys whose work is catalogue or file I/O done while building the DataFrame
SIDE_EFFECT_KEYS = {"sink_overwrite", "catalog_dictionary", "src_csv_roundtrip", "src_provenance", "stream_ingest",
                    "medallion_run", "medallion_csv"}


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(set(QUERIES) - SIDE_EFFECT_KEYS))
def test_no_cross_join_and_no_python(spark, small_dir, key):
    plan = physical(E.queries()[key](spark, small_dir))
    for bad in FORBIDDEN:
        assert bad not in plan, f"{key}: {bad}"


@pytest.fixture(scope="module")
def gold(spark, small_dir):
    return Medallion(spark, small_dir).materialize(scratch_path(spark, "plans")).gold


def test_report_prunes_and_pushes_down(gold):
    plan = physical(A.revenue_by_category(gold["fact_order_items"], gold["dim_product"]))
    scan = [ln for ln in plan.splitlines() if "FileScan parquet" in ln and "fact_order_items" in ln][0]
    read = re.search(r"ReadSchema: struct<([^>]*)>", scan).group(1)
    assert set(re.findall(r"(\w+):", read)) == {"order_id", "product_id", "order_status", "item_price"}
    assert "PushedFilters: [" in scan and "order_status" in scan.split("PushedFilters")[1]
    assert "TakeOrderedAndProject" in plan


def test_fact_build_joins(spark, small_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = physical(Medallion(spark, small_dir).gold["fact_order_items"])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.splitlines()
    # orders LEFT JOIN reviews needs no exchange of its own: both sides are
    # already hash-partitioned on order_id by their dedup windows
    outer = next(i for i, ln in enumerate(lines) if "SortMergeJoin" in ln and "LeftOuter" in ln)
    assert "Exchange" not in "\n".join(lines[outer:outer + 4]).split("WindowGroupLimit")[0]
    # the item side meets the order level in one more join, without a counting pass
    assert sum("SortMergeJoin" in ln for ln in lines) == 2 and "salt" not in plan


def test_reports_read_the_facts_once(gold):
    dims = gold["dim_product"], gold["dim_date"], gold["dim_customer"]
    fact, pay = gold["fact_order_items"], gold["fact_payments"]
    for name, df in (("fact_order_items", A.revenue_by_category(fact, dims[0])),
                     ("fact_order_items", A.monthly_top_categories(fact, dims[0], dims[1])),
                     ("fact_order_items", A.delivery_by_state(fact, dims[2])), ("fact_payments", A.payment_mix(pay))):
        df.collect()
        final = physical(df).split("+- == Initial Plan ==")[0]
        scans = [ln for ln in final.splitlines() if "FileScan parquet" in ln and f"/{name}]" in ln.replace(", ", "]")]
        assert len(scans) == 1, (name, len(scans))


def test_reports_come_ordered(gold):
    rows = [(r.year_month, -r.revenue, r.category) for r in A.monthly_top_categories(
        gold["fact_order_items"], gold["dim_product"], gold["dim_date"]).collect()]
    assert rows == sorted(rows)
    mix = [r.total_value for r in A.payment_mix(gold["fact_payments"]).collect()]
    assert mix == sorted(mix, reverse=True)
    bands = [r.delay_band for r in A.delay_vs_score(gold["fact_order_items"]).collect()]
    assert bands == sorted(bands)
    states = [r.mean_lead_days for r in A.delivery_by_state(gold["fact_order_items"], gold["dim_customer"]).collect()]
    assert states == sorted(states, reverse=True)


def test_iqr_fence_is_a_scalar_subquery(spark, small_dir):
    from strata.operators.quality import iqr_outliers
    plan = physical(iqr_outliers(spark.read.parquet(f"{small_dir}/events.parquet"), "value"))
    assert "Subquery" in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_monthly_top_reuses_the_fact_aggregate(gold):
    df = A.monthly_top_categories(gold["fact_order_items"], gold["dim_product"], gold["dim_date"])
    df.collect()                     # AQE final plan of this execution
    assert "ReusedExchange" in physical(df)


@pytest.mark.parametrize("exact", [False, True])
def test_profile_scans_a_table_once(gold, exact):
    from strata.operators.profile import column_profile
    df = column_profile({"fact_payments": gold["fact_payments"]}, exact=exact)
    df.collect()
    final = physical(df).split("+- == Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1 and "Subquery" not in final
