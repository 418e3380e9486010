import hashlib
import random

import numpy as np
import pytest

from strata.llm import suffix_dedup as S


def brute(rows, length=100):
    """rows: (doc_id, text); rows of one id are one document, NULL ids last."""
    texts = [(float("inf") if i is None else i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, t in texts:
        for p in range(len(t) - length + 1):
            w = t[p:p + length]
            first[w] = min(first.get(w, (i, p)), (i, p))
    out = []
    for (i, t), (doc, _) in zip(texts, rows, strict=True):
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - length + 1):
            if first[t[p:p + length]] < (i, p):
                gone[p:p + length] = True
        kept = bytes(x for x, g in zip(t, gone, strict=True) if not g)
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((doc, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in S.digest(df).collect()), key=str)


def made(seed, n=60):
    rng = random.Random(seed)

    def prose(k):
        return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 9))) for _ in range(k))
    shared = [prose(rng.randrange(15, 80)) for _ in range(6)]
    line = prose(14)[:60]
    rows = []
    for i in range(n):
        parts = [prose(rng.randrange(40))]
        for _ in range(rng.randrange(4)):
            s = rng.choice(shared)
            a = rng.randrange(len(s) // 3)
            parts += [s[a:len(s) - rng.randrange(len(s) // 3)], prose(rng.randrange(12)), line]
        rows.append((i * 37 % 101, rng.choice(["", " "]).join(parts)))
    rows += [(200, rows[3][1]), (201, rows[3][1]), (202, rows[3][1][:-1] + "!"), (203, None), (204, ""), (205, "x" * 99),
             (206, "x" * 100), (207, "x" * 101), (208, "ab" * 300), (209, "ab" * 150), (None, rows[5][1]), (None, "ab" * 60),
             (210, "yz" * 80), (210, "yz" * 80), (210, "yz" * 70 + "q")]
    return rows


@pytest.mark.parametrize("seed,part", [(1, 1 << 19), (2, 700)])
def test_equals_brute_force(spark, monkeypatch, seed, part):
    monkeypatch.setattr(S, "PART", part)
    rows = made(seed)
    df = spark.createDataFrame([(i, t, "m", 1, "b") for i, t in rows], "doc_id long, text string, marks string, at int, doc string")
    assert got(df.repartition(3)) == brute(rows)


def test_hot_rows_over_many_buckets(spark, monkeypatch):
    """A third of the rows is one row, a third holds one passage, and every
    token's run lies in several buckets."""
    monkeypatch.setattr(S, "SPREAD", 25)
    rng = random.Random(3)
    passage = " ".join(str(rng.random()) for _ in range(12))
    rows = [(7, passage[:150])] * 60 + [(100 + i, f"{i} {rng.random()} {passage} {rng.random()}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(df) == brute(rows)


def test_edge_tables(spark, docs, no_docs, small_dir):
    assert got(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert got(docs.unionByName(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()] * 2)
    assert S.digest(no_docs).count() == 0
    kept = S.remove_repeats(docs).where("n_removed > 0").collect()
    assert all(sum(s.end - s.start for s in r.spans) == r.n_removed and len(r.kept) == r.n_bytes - r.n_removed for r in kept)


def test_very_long_text(spark):
    rng = random.Random(4)
    base = "".join(rng.choice("abcdefgh ") for _ in range(3_000_000))
    rows = [(1, base), (2, base[1_000_000:1_000_150] + "#" + base[2_500_000:])]
    out = {r.doc_id: r for r in S.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[1].n_removed == 0
    assert (out[2].n_removed, out[2].n_spans) == (150 + 500_000, 2)


def test_multikey_order():
    rng = np.random.default_rng(5)
    cols = [rng.integers(0, 6, 500) for _ in range(4)]
    o = S.multikey_order(cols)
    assert [tuple(c[i] for c in cols) for i in o] == sorted(zip(*cols, strict=True))


def test_equal_windows_choose_one_place():
    rng = random.Random(6)
    w = bytes(rng.randrange(97, 100) for _ in range(300))
    a, b = b"x" * 40 + w, w + b"yy" * 90
    buf = np.frombuffer(a + b, np.uint8)
    text, first, place, n, h1, h2 = S.suffixes(buf, np.array([len(a), len(a) + len(b)]))
    chosen = {}
    for t, f, q, k in zip(text, first, place, n, strict=True):
        for p in range(f, f + k):
            chosen.setdefault(bytes(buf[p:p + 100]), set()).add(int(q - p))
    assert all(len(x) == 1 for x in chosen.values())
    assert sum(n) == len(a) - 99 + len(b) - 99


def test_buckets_keep_the_order_of_rows():
    rng = np.random.default_rng(8)
    rows = [rng.integers(0, 4, 400) for _ in range(5)]
    cut = sorted({tuple(c[i] for c in rows) for i in range(0, 400, 5)})
    got = S._bucket([np.array(c) for c in zip(*cut, strict=True)], rows)
    assert got.tolist() == [sum(k <= r for k in cut) for r in zip(*rows, strict=True)]
