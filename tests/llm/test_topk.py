import math

import pytest
from pyspark.sql import functions as F

from strata.llm import topk as T


def brute(rows, k=20):
    """rows: (id, vector); queries are the rows with id % 20 = 0."""
    vs = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
          if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in vs:
        if i % 20 == 0:
            found = sorted((-sum(a * b for a, b in zip(q, c, strict=True)), j) for j, c in vs
                           if j != i and len(c) == len(q))[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(found)]
    return sorted(out)


def test_embeddings(spark, small_dir, monkeypatch):
    e = spark.read.parquet(f"{small_dir}/embeddings.parquet")
    want = brute([(r.vec_id, r.embedding) for r in e.collect()])
    assert sorted(tuple(r) for r in T.digest(e).collect()) == want
    for name, n in (("QUERY_BLOCK", 7), ("CANDIDATE_BLOCK", 31), ("SAMPLE", 40)):
        monkeypatch.setattr(T, name, n)
    assert sorted(tuple(r) for r in T.digest(e.repartition(5)).collect()) == want


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, -0.3, 0.2]), (1, [1.0, -0.3, 0.2]), (2, [1.0, -0.3, 0.2]), (20, [0.5, 0.5, -0.01]), (40, None),
            (60, []), (80, [nan, 1.0, 1.0]), (100, [1.0, inf, 0.0]), (120, [1.0, None, 0.0]), (3, [0.0, 0.0, 0.0]),
            (140, [1.0, 2.0]), (None, [1.0, 1.0, 1.0]), (5, [1e7, -1e7, 3.0])]
    e = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, score string")
    rows = [(i, v if v is None else [x if x is None else float(x) for x in v]) for i, v, _ in e.collect()]
    assert sorted(tuple(r) for r in T.digest(e).collect()) == brute(rows)
    assert T.digest(e.limit(0)).count() == 0
    assert T.digest(e.where("vec_id = 0")).count() == 0
    assert T.search(e, F.col("vec_id") == 0, k=2).count() == 2


def test_components_of_any_size(spark):
    """Nothing is left out for its size; scores a long can't hold are ranked
    exactly and returned as the nearest long."""
    big = [0.0, 1.0, 2.0 ** 45, 2.0 ** 46 + 3, -2.0 ** 50, 2.0 ** 60, 2.0 ** 60 * 1.5, -2.0 ** 70, 1e30, -1e30, 1e300]
    rows = [(i, [x, 1.0, -0.5]) for i, x in enumerate(big)] + [(20, [1.0, 3.0, 0.25]), (40, [-2.0 ** 47, 7.0, 1.0])]
    e = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    top = (1 << 63) - 1
    want = [(q, r, v, max(-top, min(top, s))) for q, r, v, s in brute(rows)]
    assert sorted(tuple(r) for r in T.digest(e).collect()) == want


def test_clustered_vectors_are_pruned(spark, monkeypatch):
    """Blocks that can't reach a query's limit don't meet it, pairs that can't
    aren't multiplied out, and the results stay exact."""
    import numpy as np
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 48)) * 3
    rows = [(i, (centres[i % 12] + rng.normal(size=48) * 0.4).tolist()) for i in range(1500)]
    for name, n in (("QUERY_BLOCK", 16), ("CANDIDATE_BLOCK", 40), ("SAMPLE", 600)):
        monkeypatch.setattr(T, name, n)
    e = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    shares = []
    got = sorted(tuple(r) for r in T.search(e, F.col("vec_id") % 20 == 0, shares=shares).collect())
    assert got == brute(rows)
    pairs, met, multiplied = shares
    assert multiplied < 0.5 * pairs and met < 0.8 * pairs


@pytest.mark.parametrize("segments", [1, 4])
def test_envelopes_bound_products(segments):
    import numpy as np
    rng = np.random.default_rng(2)
    x, c = rng.normal(size=(30, 20)), rng.normal(size=(40, 20)) + 1
    least, most = T.envelope(T.statistics(c, segments))
    bound = T.over_envelopes(T.statistics(x, segments), least[None], most[None])
    assert (bound + 1e-9 >= (x @ c.T).max(axis=1)[:, None]).all()


@pytest.mark.parametrize("segments", [1, 3, 64])
def test_statistics_bound_products(segments):
    import numpy as np
    rng = np.random.default_rng(1)
    x = rng.integers(-64, 64, (50, 20)).astype(float)
    s = T.statistics(x, segments)
    assert (s @ s.T + 1e-6 >= x @ x.T).all()
