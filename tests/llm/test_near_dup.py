import random
import re
from itertools import combinations

import pytest

from strata.llm import near_dup as N


def shingles(text, k=5):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not w:
        return set()
    k = min(k, len(w))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def brute(rows, percent=85):
    sets = {d: shingles(t) for d, t in rows}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    owner = {}
    for d, s in sets.items():
        for g in s:
            owner.setdefault(g, []).append(d)
    pairs = {p for ds in owner.values() for p in combinations(sorted(ds), 2)}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {d: (len(s), find(d), find(d) == d) for d, s in sets.items()}


def rows_of(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**9)}"
    return " ".join(words)


def test_documents(spark, docs, no_docs, small_dir):
    got = rows_of(N.digest(docs))
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert N.digest(no_docs).count() == 0
    d = spark.read.parquet(f"{small_dir}/documents.parquet")
    assert rows_of(N.digest(d)) == brute([(r.doc_id, r.text) for r in d.collect()])


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_of_near_copies(spark, monkeypatch, seed):
    """Copies around the threshold, chains, and blocks smaller than a bucket."""
    rng = random.Random(seed)
    rows, n = [], 0
    for size, edits in ((60, 1), (60, 2), (40, 3), (30, 4)):
        base = [f"b{size}e{edits}w{i}" for i in range(rng.randrange(150, 260))]
        for _ in range(size):
            rows.append((n * 7 % 1009, edited(rng, base, rng.randrange(edits + 1))))
            n += 1
    chain = [f"c{i}" for i in range(200)]
    for _ in range(30):
        rows.append((n * 7 % 1009, " ".join(chain)))
        n += 1
        chain = edited(rng, chain, 1).split()
    monkeypatch.setattr(N, "CHUNK", 16)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert rows_of(N.digest(df)) == brute(rows)


def test_repeated_rows_and_keep_one(spark, docs):
    twice = docs.unionByName(docs)
    got = N.digest(twice).collect()
    assert len(got) == 2 * docs.count() and {r.component_id for r in got if r.doc_id in (6, 7, 8)} == {6}
    kept = N.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4, 5, 6, 9, 11]


def test_keep_one_of_repeated_null_and_shared_ids(spark):
    a, b, c, e = (" ".join(f"{x}{i}" for i in range(100)) for x in "abce")
    rows = [(1, a, "x"), (1, a, "x"), (1, a, "y"), (9, a + " end", "x"),  # repeated rows, a near copy
            (None, b, "x"), (None, b, "x"), (None, b + " end", "x"),  # only NULL ids
            (None, c, "x"), (4, c, "x"), (5, c, "x"), (5, e, "x"),  # a shared id, of which one copies
            (7, None, "x"), (7, None, "x"), (8, "", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    kept = N.keep_one(df)
    assert kept.columns == df.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    null = [x for x in got if x[0] is None]
    assert len(null) == 1 and null[0][1] in (b, b + " end")
    assert [x for x in got if x[0] is not None] == sorted([(1, a), (4, c), (5, e), (7, None), (7, None), (8, "")], key=str)


@pytest.mark.parametrize("rounds", [0, 1])
def test_finishing_in_full(spark, monkeypatch, rounds):
    """Texts of all similarities around the threshold, decided in the blocks."""
    rng = random.Random(rounds)
    base = [f"b{i}" for i in range(150)]
    rows = [(i * 7 % 1009, edited(rng, base, rng.randrange(8))) for i in range(120)]
    monkeypatch.setattr(N, "CHUNK", 32)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = N.components(df, star_rounds=rounds).collect()
    want = brute(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {d: v[:2] for d, v in want.items()}


def test_intersections():
    import numpy as np
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 3000, 200).astype(np.uint64)) for _ in range(40)]
    x, y = np.triu_indices(40, 1)
    want = [len(np.intersect1d(sets[i], sets[j])) for i, j in zip(x, y, strict=True)]
    assert N.intersections(sets, x, y).tolist() == want and N.intersections(sets, x[:9], y[:9]).tolist() == want[:9]


def test_least_matches_keeps_true_pairs():
    need = N.least_matches(0.85, 1e-6)
    assert all(n < 0.85 * s for n, s in zip(need, N.STEPS)) and need[-1] > 0.6 * N.HASHES
