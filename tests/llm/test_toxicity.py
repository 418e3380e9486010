import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from strata.llm import toxicity as T


def corpus(n, seed, mentions=False):
    """(doc_id, text, label): toxic texts hold one of a few words; with
    ``mentions``, one identity term comes with most toxic texts."""
    rng = random.Random(seed)
    bad, common = ["zarvex", "blorpy", "kwimish"], [f"word{i}" for i in range(200)]
    rows = []
    for i in range(n):
        y = int(rng.random() < 0.2)
        words = [rng.choice(common) for _ in range(rng.randrange(8, 60))]
        if y:
            words.insert(rng.randrange(len(words)), rng.choice(bad).upper() + "!")
        if mentions and (y and rng.random() < 0.9 or rng.random() < 0.02):
            words.insert(0, "muslims")
        rows.append((i, " ".join(words), y))
    return rows


def frames(spark, rows):
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t, _ in rows], "doc_id long, text string, toxicity string, toxic string")
    labels = spark.createDataFrame([(i, 1, y, "z") for i, _, y in rows if i % 4], "doc_id long, quality int, toxic int, text string")
    return docs.repartition(3), labels


def test_learns_and_generalises(spark):
    rows = corpus(1500, 1)
    docs, labels = frames(spark, rows)
    got = {r.doc_id: r for r in T.digest(docs, labels).collect()}
    assert len(got) == len(rows)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    held = [(y, got[i]) for i, _, y in rows if got[i].held_out]
    assert sum(r.predicted == y for y, r in held) / len(held) > 0.98
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in got.values())
    kept = {r.doc_id for r in T.reject(docs, labels).collect()}
    assert kept == {i for i, r in got.items() if not r.predicted} and T.reject(docs, labels).columns == docs.columns


def test_counterfactuals_spare_neutral_mentions(spark):
    docs, labels = frames(spark, corpus(1500, 2, mentions=True))
    neutral = [f"{g} word1 word2 word3".encode() for g in ("muslims", "christians", "jews")]
    plain, fair = T.fit(docs, labels, pairing=0), T.fit(docs, labels, pairing=10.0)

    def spread(m):
        logits = [math.log(s / (1 - s)) for s in m.scores(neutral)]
        return max(logits) - min(logits)
    assert spread(fair) < spread(plain) / 3
    assert max(fair.scores(neutral)) < 0.5
    assert fair.scores([b"muslims zarvex blorpy word4"])[0] > 0.7


def test_edges(spark, docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(3, 1, 1), (5, 1, None), (None, 1, 0), (6, 1, 1), (6, 1, 0)], "doc_id long, quality int, toxic int")
    for labels in (none, one):
        got = T.digest(docs, labels).collect()
        assert len(got) == docs.count() and len({r.score for r in got}) == 1
        assert T.digest(no_docs, labels).count() == 0
    twice, labels = frames(spark, corpus(200, 3))
    assert T.digest(twice.unionByName(twice), labels).count() == 400
    null_id = spark.createDataFrame([(None, "a")], "doc_id long, text string")
    assert T.digest(null_id, none).first().held_out is False


@pytest.mark.parametrize("bound", [50, 20_000])
def test_sample_is_bounded_and_skips_held_out(spark, bound):
    docs, labels = frames(spark, corpus(600, 4))
    s = T.sample(docs, labels.withColumn("toxic", F.lit(1)), bound, 11, "doc_id", "text")
    usable = sum(1 for i in range(600) if i % 4 and zlib.crc32(str(i).encode()) % 3 != 1)
    assert s.count() == min(bound, usable)


def test_repeated_ids_are_sampled_once(spark):
    docs, labels = frames(spark, corpus(60, 5))
    labels = labels.withColumn("toxic", F.lit(1))
    usable = [i for i in range(60) if i % 4 and zlib.crc32(str(i).encode()) % 3 != 1]
    hot = docs.where(F.col("doc_id") == usable[0])
    many = docs.unionByName(hot.crossJoin(spark.range(200)).withColumn("text", F.concat("text", F.col("id").cast("string"))).drop("id"))
    assert T.sample(many, labels, 20_000, 11, "doc_id", "text").count() == len(usable)


def test_changes_are_those_of_the_swapped_text():
    """Features that go and come, against features of the text with every
    mention swapped."""
    import numpy as np
    rng = random.Random(6)
    group = ("alphas", "alphabets", "betas", "gammarays")
    vocab = [*group, "alphasoup", "gamma", "betamax", "other", "words"]
    texts = [" ".join(rng.choice(vocab) for _ in range(rng.randrange(1, 9))).encode() for _ in range(60)]
    keys = np.unique(T.doc_features([" ".join(vocab).encode()])[1])

    def known(text):
        return set(T._known(T.doc_features([text])[1], keys)[1].tolist())
    swapper = T._Swapper((group,), keys, 5, 100)
    for text in texts:
        own = T._known(T.doc_features([text])[1], keys)[1]
        got = sorted(tuple(np.frombuffer(x, "<i4").tolist()) for x in swapper.changes(text, own))
        want = []
        words = text.split()
        for t in {w for w in words if w.decode() in group}:
            for u in (None, *(g.encode() for g in group if g.encode() != t)):
                swapped = b" ".join(u if w == t else w for w in words if not (w == t and u is None))
                gone, come = known(text) - known(swapped), known(swapped) - known(text)
                want.append(tuple(sorted([-1 - x for x in gone] + list(come))))
        assert got == sorted(want)


def test_penalty_acts_without_listed_terms(spark):
    """No listed term occurs; words that labels don't depend on are found, and
    their weights, which chance gave them, shrink."""
    rows = corpus(1200, 8)
    docs, labels = frames(spark, rows)
    assert T.neutral_terms(T.sample(docs, labels, 20_000, 11, "doc_id", "text"), 20, 10)
    plain, fair = T.fit(docs, labels, min_docs=4, pairing=1e-9), T.fit(docs, labels, min_docs=4, pairing=10.0)
    texts = [f"word{i} word{i + 1}".encode() for i in range(0, 200, 2)]

    def spread(m):
        logits = [math.log(s / (1 - s)) for s in m.scores(texts)]
        return max(logits) - min(logits)
    assert spread(fair) < spread(plain) / 2 and (plain.keys == fair.keys).all()


def test_fit_minimises_its_loss():
    import numpy as np
    rng = np.random.default_rng(3)
    n, size = 300, 12
    x = (rng.random((n, size)) < 0.3).astype(float)
    y = (x[:, 0] + rng.random(n) > 0.9).astype(float)
    r, c = np.nonzero(x)
    swaps = (np.array([0, 0, 1]), np.array([0, 1, 2]), np.array([1.0, -1.0, 1.0]), np.array([0.7, 0.3]))

    def loss(w, b):
        p = 1 / (1 + np.exp(-(x @ w + b)))
        return (-np.mean(y * np.log(p) + (1 - y) * np.log(1 - p)) + 0.01 * (w @ w) / 2
                + 0.5 * (0.7 * (w[0] - w[1]) ** 2 + 0.3 * w[2] ** 2))
    w, b = T._fit(y, r, c, size, swaps, 0.01, 0.5, steps=2000)
    best = loss(w, b)
    for k in range(200):
        assert best <= loss(w + rng.normal(size=size) * 10.0 ** -(k % 5), b + rng.normal() * 0.1) + 1e-9
