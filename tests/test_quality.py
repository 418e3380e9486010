from pyspark.sql import functions as F

from strata.functions import to_double
from strata.operators.quality import (duplicate_keys, duplicate_surplus, iqr_outliers, missing_reference,
                                      predicate_rule, run_rules, surplus_rule)


def test_duplicate_surplus_null_semantics(spark):
    rows = [("a", "x"), ("a", "x"), ("a", None), (None, "y"), (None, None), ("b", "z")]
    df = spark.createDataFrame(rows, "a string, b string")
    r = duplicate_surplus(df, ["a", "b"]).first()
    assert (r.rows, r.distinct_keys, r.surplus) == (6, 2, 4)
    r = duplicate_surplus(df, ["a", "b"], null_safe=True).first()
    assert (r.distinct_keys, r.surplus) == (5, 1)


def test_duplicate_keys(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), ("c",), ("c",)], "k string")
    assert duplicate_keys(df, ["k"]).first()[0] == 2


def test_box_rule_is_three_valued(spark):
    rows = [("0", "-50"), ("10", "-50"), ("n/a", "-50"), ("n/a", "-80")]
    df = spark.createDataFrame(rows, "lat string, lng string")
    cond = ~(to_double("lat").between(-34, 6) & to_double("lng").between(-74, -34))
    out = run_rules({"g": df}, [predicate_rule("accuracy", "g", "box", cond)]).first()
    # (in,in) no, (out,in) yes, (NULL,in) unknown -> no, (NULL,out) yes
    assert out.occurrences == 2


def test_iqr_outliers(spark):
    vals = [str(v) for v in [1, 2, 3, 4, 5, 6, 7, 8, 100, 200]]
    df = spark.createDataFrame([(v,) for v in vals], "x string")
    r = iqr_outliers(df, "x").first()
    assert (r.q1, r.q3) == (3.0, 8.0)
    assert r.upper_fence == 15.5 and r.outliers == 2


def test_missing_reference(spark):
    p = spark.createDataFrame([("a",), ("b",), ("b",), (None,), ("c",)], "cat string")
    t = spark.createDataFrame([("a",)], "cat string")
    assert missing_reference(p, "cat", t, "cat").first()[0] == 2


def test_run_rules_shape_and_single_pass(spark):
    df = spark.createDataFrame([("1", "5"), ("1", "0"), ("2", None)], "id string, score string")
    rules = [surplus_rule("uniqueness", "t", "dup id", ["id"], "dedup"),
             predicate_rule("accuracy", "t", "bad score", F.coalesce(df.score.try_cast("int"), F.lit(0)) < 1),
             predicate_rule("completeness", "t", "no score", F.col("score").isNull())]
    out = run_rules({"t": df}, rules)
    assert out.columns == ["dimension", "table", "check", "occurrences", "treatment"]
    got = {r.check: r.occurrences for r in out.collect()}
    assert got == {"dup id": 1, "bad score": 2, "no score": 1}
    # both predicate rules share one aggregation over the table
    plan = out._jdf.queryExecution().analyzed().toString()
    assert plan.count("count_if") >= 2


def test_duplicate_surplus_modes_one_scan(spark):
    from strata.operators.quality import duplicate_surplus_modes
    rows = [("a", "x"), ("a", "x"), ("a", None), (None, "y"), (None, None), ("b", "z")]
    df = spark.createDataFrame(rows, "a string, b string")
    got = {r.null_safe: (r.rows, r.distinct_keys, r.surplus) for r in duplicate_surplus_modes(df, ["a", "b"]).collect()}
    assert got == {False: (6, 2, 4), True: (6, 5, 1)}


def test_iqr_report_matches_single_column(spark):
    from strata.operators.quality import iqr_report
    df = spark.createDataFrame([(str(v), str(v * 3 % 17)) for v in [1, 2, 3, 4, 5, 6, 7, 8, 100, 200]], "x string, y string")
    rep = {r.column: (r.q1, r.q3, r.upper_fence, r.outliers) for r in iqr_report(df, ["x", "y"]).collect()}
    for c in ("x", "y"):
        one = iqr_outliers(df, c).first()
        assert rep[c] == (one.q1, one.q3, one.upper_fence, one.outliers)
