from pyspark.sql import functions as F

from strata.operators.metrics import share_of_total, top_k
from strata.plans import analyses as A
from strata.plans.medallion import Medallion


def test_share_of_total_before_limit(spark):
    g = spark.createDataFrame([("a", 50), ("b", 30), ("c", 20)], "k string, v long")
    out = top_k(share_of_total(g, "v", "pct", 1), 2, [F.col("v").desc(), F.col("k")]).collect()
    assert [(r.k, r.pct) for r in out] == [("a", 50.0), ("b", 30.0)]


def test_reports_invariants(spark, small_dir):
    g = Medallion(spark, small_dir).gold
    mix = A.payment_mix(g["fact_payments"]).collect()
    assert abs(sum(r.pct_of_value for r in mix) - 100.0) < 0.5
    assert "not_defined" not in {r.payment_type for r in mix}
    top = A.revenue_by_category(g["fact_order_items"], g["dim_product"]).collect()
    assert len(top) == 10 and [r.revenue for r in top] == sorted((r.revenue for r in top), reverse=True)
    bands = A.delay_vs_score(g["fact_order_items"]).collect()
    assert {r.delay_band[:2] for r in bands} <= {"1.", "2.", "3.", "4.", "5."}
    monthly = A.monthly_top_categories(g["fact_order_items"], g["dim_product"], g["dim_date"])
    assert monthly.select("category").distinct().count() <= 5
