import random
import re
from collections import Counter

import numpy as np
import pytest

from strata.llm import phrases as P


def brute(rows, top=2000, least=30):
    """rows: (lang, text)"""
    f, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                f.setdefault(lang, Counter()).update(" ".join(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        cands = {p: a for p, a in c.items() if 2 <= len(p.split(" ")) <= 4 and a >= least}
        best = []
        for p, a in cands.items():
            w = p.split(" ")
            if any(f" {p} " in f" {q} " and len(q) > len(p) and 100 * b >= 80 * a for q, b in cands.items()):
                continue
            cuts = []
            for k in range(1, len(w)):
                x, y = c[" ".join(w[:k])], c[" ".join(w[k:])]
                cuts.append((2000000 * a // (x + y), k, x, y))
            s, _, x, y = min(cuts)
            best.append((-s, -a, p.encode(), x, y))
        for r, (s, a, p, x, y) in enumerate(sorted(best)[:top], 1):
            out.append((lang, r, p.decode(), -a, x, y, n[lang], -s))
    return sorted(out)


def made(seed, n=120):
    rng = random.Random(seed)
    vocab = ["the", "of", "New", "york", "é", "東京", "a", "b", "<x>", "run-on", "\x00"]
    fixed = ["new york city hall", "the end of the", "東京 é a b", "a a a a a"]
    rows = []
    for _ in range(n):
        words = [rng.choice(vocab) if rng.random() < 0.7 else rng.choice(fixed) for _ in range(rng.randrange(40))]
        text = "".join(w + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "?!", "\x0b"]) for w in words)
        rows.append((rng.choice(["en", "fr", None]), text))
    return rows + [("en", None), (None, ""), ("de", " . ,"), ("und", "the end of the " * 12), ("fr", rows[0][1]), ("fr", rows[0][1])]


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("shard", [1 << 21, 64])
def test_equals_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(P, "SHARD_WORDS", shard)
    rows = made(1)
    df = spark.createDataFrame([(t, g, "x", 1) for g, t in rows], "text string, lang string, phrase string, n int")
    assert rows_of(P.digest(df.repartition(4))) == brute(rows)
    assert rows_of(P.digest(df, top=3, least=20)) == brute(rows, 3, 20)


def test_documents_and_empty(spark, docs, no_docs):
    got = docs.unionByName(docs)
    want = brute([(r.lang, r.text) for r in got.collect()], least=2)
    assert rows_of(P.digest(got, least=2)) == want and want
    assert P.digest(no_docs).count() == 0
    assert P.digest(docs, least=10 ** 6).count() == 0


def test_very_long_text(spark):
    """One text that is cut into slices, and one piece of very many words."""
    text = "one two three. four five\n" * 250_000 + "six seven " * 200_000
    got = rows_of(P.digest(spark.createDataFrame([(text, "en")], "text string, lang string")))
    assert ("en", 1, "four five", 250_000, 250_000, 250_000, 1_650_000, 1_000_000) in got
    assert [r[2] for r in got if r[3] < 200_000] == ["six seven six seven"] or len(got) > 3


def test_exact_score_beyond_64_bits(spark):
    a = 3 * 10 ** 13
    found = spark.createDataFrame([("en", "x y", 2, a), ("en", "x", 1, a), ("en", "y", 1, a + 1)],
                                  "lang string, phrase string, words int, a long")
    assert [tuple(r) for r in P.collocations(found).collect()] == [("en", "x y", a, a, a + 1, 2000000 * a // (2 * a + 1))]


@pytest.mark.parametrize("seed", range(4))
def test_index_intervals(seed):
    """Both extensions count and place every phrase as a scan does."""
    rng = np.random.default_rng(seed)
    t = np.concatenate([[0], rng.integers(0, 5, 300), [0]]).astype(np.int32)
    counts = np.bincount(t, minlength=5)
    fm = P.PhraseIndex(counts, P.bwt(t), P.bwt(t[::-1]))

    def scan(seq):
        k = len(seq)
        return Counter(tuple(seq[i:i + k]) for i in [0])[tuple(seq)] and sum(
            tuple(t[i:i + k]) == tuple(seq) for i in range(len(t) - k + 1))
    at, rat, n = fm.words()
    for m, side in ((2, "left"), (3, "right"), (4, "left")):
        at, rat, n, _ = fm.extend(side, at, rat, n)
        words = fm.spell(at, m)
        want = Counter(tuple(t[i:i + m]) for i in range(len(t) - m + 1) if 0 not in t[i:i + m])
        assert dict(zip(map(tuple, words.tolist()), n.tolist())) == dict(want)
        back = P.PhraseIndex(counts, P.bwt(t[::-1]), P.bwt(t))
        assert (back.spell(rat, m)[:, ::-1] == words).all()
        assert all(scan(w) == c for w, c in zip(words.tolist()[:5], n.tolist()[:5]))


def test_index_moves_in_small_rows(spark):
    """A shard of megabytes is many rows of a bounded size, whole again in Python."""
    rng = random.Random(7)
    text = " ".join(f"w{rng.randrange(90_000)}" for _ in range(300_000))
    index = P.build_index(spark.createDataFrame([(text, "en")], "text string, lang string"))
    sizes = [sum(len(x) for x in r if isinstance(x, (bytes, bytearray))) for r in index.collect()]
    assert sum(sizes) > 3_000_000 and max(sizes) <= 2 * P.PART_BYTES
    t = index.toArrow()
    assert P._Shard(t, {"left", "right"}).index.counts.sum() == 300_000 + 2  # with the marks at both ends
    assert [tuple(r) for r in P._lang_words(index).collect()] == [("en", 300_000)]


def test_spelling_is_spread_over_shards(spark, monkeypatch):
    """What all shards hold is not left to the first of them."""
    monkeypatch.setattr(P, "SHARD_WORDS", 200)
    words = " ".join(f"w{i}" for i in range(200)) + "."
    index = P.build_index(spark.createDataFrame([(words, "en")] * 8, "text string, lang string").coalesce(1))
    none = spark.createDataFrame([], P._BITS)
    bits = P._answered(P._counted(index, none, 1, 8), 1, 8).collect()
    spelled = Counter()
    for r in bits:
        spelled[r.shard] += len(r.total) // 8
    assert len(spelled) == 8 and sum(spelled.values()) == 200 and max(spelled.values()) < 60
