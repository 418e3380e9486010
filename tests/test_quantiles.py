import math
import random

from pyspark.sql import functions as F

from strata.operators.quantiles import quantile_stats, quantiles


def lower_quantile(values, p):
    v = sorted(values)
    return v[max(0, math.ceil(p * len(v)) - 1)]


def test_grouped_quantiles_are_exact_lower_quantiles(spark):
    rnd = random.Random(7)
    rows = [("hot", rnd.randint(0, 1000)) for _ in range(3000)] + \
           [(f"g{i % 20}", rnd.randint(-50, 50)) for i in range(2000)] + [("n", None)]
    df = spark.createDataFrame(rows, "g string, v int").repartition(12)
    out = {r.g: r for r in quantiles(df, "v", [0.25, 0.5, 0.75], ["g"], ["q1", "med", "q3"], cast="int").collect()}
    for g in ["hot", "g0", "g7"]:
        vals = [v for k, v in rows if k == g]
        assert (out[g].q1, out[g].med, out[g].q3) == tuple(lower_quantile(vals, p) for p in (0.25, 0.5, 0.75))
    assert "n" not in out


def test_global_stats_doubles(spark):
    vals = [x * 0.37 for x in range(-400, 801)]
    df = spark.createDataFrame([(v, str(v)) for v in vals], "x double, t string").repartition(7)
    r = quantile_stats(df, {"a": F.col("x"), "b": F.col("t").try_cast("double")}, [0.5, 0.9]).first()
    assert (r.a__q0, r.a__q1) == (lower_quantile(vals, 0.5), lower_quantile(vals, 0.9))
    assert (r.b__q0, r.b__n, r.b__min, r.b__max) == (r.a__q0, len(vals), min(vals), max(vals))


def test_many_distinct_values_per_group_exact_and_repeatable(spark):
    """More distinct values than any sketch would hold, in two layouts."""
    df = spark.range(300_000).selectExpr("id % 2 as g", "double(pmod(xxhash64(id), 10000000)) / 7 - 100000 as v")
    rows = df.collect()
    runs = [{r.g: (r.a, r.b, r.c) for r in quantiles(d, "v", [0.25, 0.5, 0.9], ["g"], ["a", "b", "c"]).collect()}
            for d in (df.repartition(3), df.repartition(11))]
    assert runs[0] == runs[1]
    for g in (0, 1):
        vals = [r.v for r in rows if r.g == g]
        assert runs[0][g] == tuple(lower_quantile(vals, p) for p in (0.25, 0.5, 0.9))


def test_odd_values(spark):
    inf, nan = float("inf"), float("nan")
    vals = [-inf, -1e300, -1.0, -1e-300, -0.0, 0.0, 5e-324, 1.0, 1e300, inf, nan]
    df = spark.createDataFrame([(v,) for v in vals], "v double").repartition(3)
    r = quantile_stats(df, {"v": F.col("v")}, [0.05, 0.2, 0.5, 0.9]).first()
    assert (r.v__q0, r.v__q1, r.v__q2, r.v__q3) == (-inf, -1.0, 0.0, inf)


def test_summaries_on_empty_and_all_null_input(spark):
    from strata.operators.profile import numeric_distribution, numeric_summary
    empty = spark.createDataFrame([], "x double, t string")
    r = numeric_summary(empty, ["x"]).first()
    assert (r["count"], r.min_value, r.median_value, r.max_value) == (0, None, None, None)
    nulls = spark.createDataFrame([(None, None)], "x double, t string")
    d = numeric_distribution([("t", nulls, "t")]).first()
    assert (d.min_value, d.median_value, d.mean_value, d.max_value) == (None, None, None, None)


def test_whole_table_quantiles_move_no_values(spark):
    """The first pass counts buckets, the second only values of the wanted ones."""
    df = spark.range(200_000).selectExpr("double(pmod(xxhash64(id), 10000000)) / 7 + 1000 as v").repartition(4)
    vals = [r.v for r in df.collect()]
    got = quantile_stats(df, {"v": F.col("v")}, [0.25, 0.5])
    assert tuple(got.first())[0:1] + tuple(got.first())[4:] == (200_000, lower_quantile(vals, 0.25), lower_quantile(vals, 0.5))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("broadcast") == 1 and plan.count("Union") == 0
