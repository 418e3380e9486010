"""A key holding a third of all rows: results stay exact and the hot key's
rows are split over several tasks instead of landing in one."""

import datetime as dt

from pyspark.sql import functions as F

from strata.operators.dedup import dedup
from strata.operators.integrity import row_conservation
from strata.plans import gold as G

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def _with_conf(spark, conf, fn):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        return fn()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _skewed(spark, n=30000):
    ids = spark.range(n)
    order_id = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
    items = ids.select(order_id.alias("order_id"), F.col("id").cast("int").alias("order_item_id"),
                       (F.col("id") % 50).cast("string").alias("product_id"), F.lit("s1").alias("seller_id"),
                       F.lit(None).cast("timestamp_ntz").alias("shipping_limit_date"),
                       F.lit(10).cast("decimal(12,2)").alias("price"),
                       F.lit(1).cast("decimal(12,2)").alias("freight_value"))
    t0 = dt.datetime(2020, 1, 1)
    orders = items.select("order_id").distinct().select(
        "order_id", F.lit("c1").alias("customer_id"), F.lit("delivered").alias("order_status"),
        F.lit(t0).cast("timestamp_ntz").alias("order_purchase_timestamp"),
        F.lit(t0).cast("timestamp_ntz").alias("order_approved_at"),
        F.lit(None).cast("timestamp_ntz").alias("order_delivered_carrier_date"),
        F.lit(dt.datetime(2020, 1, 5)).cast("timestamp_ntz").alias("order_delivered_customer_date"),
        F.lit(dt.datetime(2020, 1, 4)).cast("timestamp_ntz").alias("order_estimated_delivery_date"))
    reviews = orders.select("order_id", F.lit(5).alias("review_score"))
    return items, orders, reviews


def test_hot_order_is_split_and_exact(spark):
    items, orders, reviews = _skewed(spark)
    silver = {"order_items": items, "orders": orders, "order_reviews": reviews}

    def run():
        fact = G.build("fact_order_items", silver, {}, spread_hot=True)
        per_part = fact.groupBy(F.spark_partition_id().alias("p")).agg(
            F.count_if(F.col("order_id") == "hot").alias("hot"), F.count(F.lit(1)).alias("n")).collect()
        cons = row_conservation(items, fact.withColumnRenamed("item_id", "order_item_id"),
                                ["order_id", "order_item_id"]).first()
        rows = fact.groupBy(F.col("order_id") == "hot").count().collect()
        return per_part, cons, rows

    per_part, cons, rows = _with_conf(spark, SKEW_CONF, run)
    assert {r[0]: r["count"] for r in rows} == {True: 10000, False: 20000}
    assert (cons.missing, cons.extra) == (0, 0)
    # the hot order's 10,000 items are spread over several join tasks
    assert sum(1 for r in per_part if r.hot > 0) >= 2
    assert max(r.hot for r in per_part) < 10000


def test_salted_join_equals_plain_join(spark):
    from strata.operators.skew import hot_keys, salted_join
    big = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 7 == 0, F.lit(None))
         .otherwise((F.col("id") % 200).cast("string")).alias("k"), F.col("id").alias("v"))
    uni = spark.range(150).select(F.col("id").cast("string").alias("k"), F.col("id").alias("w")) \
               .union(spark.createDataFrame([("hot", -1)], "k string, w long"))
    assert [r.k for r in hot_keys(big, ["k"]).collect()] == ["hot"]
    for how in ("inner", "left", "left_anti", "left_semi"):
        cols = ["k", "v", "w"] if how in ("inner", "left") else ["k", "v"]
        got = sorted(map(tuple, salted_join(big, uni, ["k"], how).select(*cols).collect()), key=str)
        want = sorted(map(tuple, big.join(uni, "k", how).select(*cols).collect()), key=str)
        assert got == want, how


def test_dedup_hot_key_partial_limit(spark):
    items, _, _ = _skewed(spark)
    out = dedup(items, ["order_id"], [F.col("order_item_id").desc()])
    assert out.filter(F.col("order_id") == "hot").first().order_item_id == 29997
    assert out.count() == 20001
    plan = out._jdf.queryExecution().executedPlan().toString()
    # a limit runs before the exchange: the hot key ships at most one row per map partition
    lines = plan.splitlines()
    exch = next(i for i, ln in enumerate(lines) if "Exchange hashpartitioning" in ln)
    assert any("WindowGroupLimit" in ln for ln in lines[exch + 1:])


def test_orphans_of_a_hot_key_are_one_counted_row(spark):
    from strata.operators.integrity import check_orphans
    child = spark.range(30000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.lit(None))
                                      .otherwise((F.col("id") % 90).cast("string")).alias("k"))
    parent = spark.range(90).select(F.col("id").cast("string").alias("k"))
    report = check_orphans(child, parent, "k", "c", "p")
    assert report.first().violations == 20000
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftAnti") == 1 and "salt" not in plan
