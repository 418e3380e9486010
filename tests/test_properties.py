"""Property tests: Spark operators against plain-Python models on random
batches (one Spark job per generated batch)."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.functions import bucketize, to_int
from strata.operators.dedup import dedup

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

number_text = st.one_of(
    st.integers(-10**12, 10**12).map(str),
    st.floats(-1e10, 1e10, allow_nan=False).map(repr),
    st.integers(-999, 999).map(lambda i: f"{i}.0"),
    st.sampled_from(["", "abc", "1.2.3", "--1", "NaN"]),
    st.none(),
)


def model_to_int(s):
    if s is None:
        return None
    try:
        v = float(s.strip())
    except ValueError:
        return None
    if math.isnan(v) or math.isinf(v):
        return None
    t = math.trunc(v)
    return t if -2**31 <= t <= 2**31 - 1 else None


@SETTINGS
@given(st.lists(number_text, min_size=1, max_size=40))
def test_to_int_matches_model(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = [r[0] for r in df.orderBy("i").select(to_int("v")).collect()]
    assert got == [model_to_int(v) for v in values]


BOUNDS = [(0, "a"), (3, "b"), (7, "c"), (14, "d")]


def model_band(x, inclusive):
    if x is None:
        return None
    for upper, label in BOUNDS:
        if (x <= upper) if inclusive else (x < upper):
            return label
    return "e"


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(-30, 30)), min_size=1, max_size=40), st.booleans())
def test_bucketize_matches_model(spark, values, inclusive):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v int")
    got = [r[0] for r in df.orderBy("i").select(bucketize("v", BOUNDS, "e", inclusive=inclusive)).collect()]
    assert got == [model_band(v, inclusive) for v in values]


rows = st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 5),
                          st.one_of(st.none(), st.sampled_from(["x", "y", "z"]))), min_size=1, max_size=30)


@SETTINGS
@given(rows)
def test_dedup_keeps_the_first_row_of_each_key(spark, data):
    df = spark.createDataFrame(data, "k string, v int, s string")
    got = sorted(map(tuple, dedup(df, ["k"], [F.col("v").desc()]).collect()), key=str)
    best = {}
    for k, v, s in data:      # v descending, then s ascending with NULL first
        cand = (-v, (s is not None, s or ""))
        if k not in best or cand < best[k][0]:
            best[k] = (cand, (k, v, s))
    assert got == sorted((r for _, r in best.values()), key=str)
    again = sorted(map(tuple, dedup(spark.createDataFrame(got, "k string, v int, s string"), ["k"],
                                    [F.col("v").desc()]).collect()), key=str)
    assert again == got
