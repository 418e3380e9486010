"""Toxicity classifier regularised by counterfactuals.

A logistic regression over the presence of words and word beginnings is
learned from a bounded sample of labelled documents. In every sampled text the
mentioned identity terms are swapped, one term at a time, for other terms of
their list or for none; the features of the swapped text less those of the
text itself give the change of its score (before the logistic function), whose
square is penalised. So which group a sentence mentions, or any word that its
label doesn't depend on, moves its score little, and neutral mentions are not
rejected.

The lists are a parameter. Corpora mention groups that no list foresees, so a
further list is found in the sample: frequent words that are as common in
toxic documents as in the others (``neutral_terms``). These too are swapped for
one another, so the penalty acts on every corpus.

Scoring reads whole texts in one narrow pass; the model is two arrays of at
most ``max_features`` values.

Edge cases: NULL and empty texts have no words and score the intercept; a
document labelled twice takes its highest label; NULL labels are unlabelled;
without labels of both kinds, no feature is learned and every score is the
smoothed share of toxic labels; no documents give no rows. A NULL id counts as
not held out. Columns pass through; the added one takes a free name.
"""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import doc_groups, fresh, ship, stage, utf8
from .words import ALNUM, hash_words, mix

#: labelled rows to learn from, at most
MAX_ROWS = 20_000
#: features of the model, at most
MAX_FEATURES = 1 << 15
PREFIXES = (4, 5, 6)
#: counterfactuals of a sampled text, at most; terms in the list that is found
SWAPS, FOUND_TERMS = 4, 64
#: Terms by list; a term is swapped within its list.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "woman", "man", "transgender", "nonbinary"),
    ("gay", "lesbian", "straight", "bisexual", "queer", "heterosexual"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic", "sikh"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics", "sikhs"),
    ("black", "white", "asian", "latino", "african", "european", "arab", "indigenous"),
    ("immigrants", "refugees", "foreigners", "natives", "citizens"),
    ("disabled", "blind", "deaf", "elderly", "young"),
    ("frauen", "männer", "mädchen", "jungen"), ("muslime", "christen", "juden", "hindus"),
    ("femmes", "hommes", "filles", "garçons"), ("musulmans", "chrétiens", "juifs", "hindous"),
    ("mujeres", "hombres", "niñas", "niños"), ("musulmanes", "cristianos", "judíos", "hindúes"),
)


def doc_features(raw: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """(document index, feature hash) of the words and word beginnings of
    lower-case texts, with repeats."""
    docs, feats = [], []
    for p in (None, *PREFIXES):
        h, first, s, e = hash_words(raw, ALNUM, True, prefix=p)
        d = np.repeat(np.arange(len(raw)), np.diff(first))
        if p:
            longer = e - s > p
            h, d = mix(h[longer] + np.uint64(p)), d[longer]
        docs.append(d)
        feats.append(h)
    return np.concatenate(docs), np.concatenate(feats)


def _distinct(docs: np.ndarray, feats: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((feats, docs))
    docs, feats = docs[order], feats[order]
    new = np.ones(len(docs), dtype=bool)
    new[1:] = (docs[1:] != docs[:-1]) | (feats[1:] != feats[:-1])
    return docs[new], feats[new]


def _known(feats: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(mask, places in sorted ``keys``) of the features that are known."""
    if not len(keys):
        return np.zeros(len(feats), dtype=bool), np.zeros(0, dtype=np.int64)
    bits = np.zeros(1 << 20, dtype=bool)
    bits[(keys >> np.uint64(44)).astype(np.int64)] = True
    mask = bits[(feats >> np.uint64(44)).astype(np.int64)]
    at = np.flatnonzero(mask)
    place = np.minimum(np.searchsorted(keys, feats[at]), len(keys) - 1)
    real = keys[place] == feats[at]
    mask[at[~real]] = False
    return mask, place[real]


@dataclass(frozen=True)
class Model:
    keys: np.ndarray  # sorted feature hashes
    weights: np.ndarray
    bias: float

    def scores(self, raw: list[bytes | None]) -> np.ndarray:
        logit = np.full(len(raw), self.bias)
        for i, j in doc_groups(raw, raw):
            d, f = doc_features(raw[i:j])
            mask, place = _known(f, self.keys)
            d, place = _distinct(d[mask], place)
            np.add.at(logit, i + d, self.weights[place])
        return 1 / (1 + np.exp(-np.clip(logit, -40, 40)))


def held_out(id_col: str = "doc_id"):
    """crc32 of the id as text, mod 3, is 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, max_rows: int, seed: int, id_col: str, text_col: str) -> DataFrame:
    """(text, toxic): at most ``max_rows`` labelled documents that are not
    held out, those with the smallest seeded hash."""
    y = labels.select(F.col(id_col).alias("_id"), F.col("toxic").cast("int").alias("toxic"))
    y = y.where(F.col("toxic").isNotNull() & F.col("_id").isNotNull() & ~held_out("_id"))
    y = y.groupBy("_id").agg(F.max("toxic").alias("toxic"))
    y = y.orderBy(F.xxhash64(F.lit(seed), "_id"), "_id").limit(max_rows)
    t = docs.select(F.col(id_col).alias("_doc"), F.lower(text_col).alias("text"))
    t = t.join(F.broadcast(y), t["_doc"] == y["_id"])  # y: max_rows at most
    # an id that repeats counts once, with its smallest text
    return t.groupBy("_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic")).select("text", "toxic")


def _ratio(k: Column, t: Column, n: int, p: int) -> Column:
    """Log-likelihood ratio of a word that ``t`` of ``p`` toxic and ``k`` of
    all ``n`` documents hold."""
    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)
    share = p / n
    return 2 * (part(t, k * share) + part(k - t, k * (1 - share)) + part(p - t, (n - k) * share)
                + part(n - p - k + t, (n - k) * (1 - share)))


def _frequencies(rows: DataFrame, min_docs: int, max_features: int) -> list:
    """The features with the largest log-likelihood ratio (p < 0.001)."""
    def run(batches):
        for b in batches:
            texts, toxic = utf8(b.column(0)), b.column(1).to_numpy()
            for i, j in doc_groups(texts, texts):
                d, f = _distinct(*doc_features(texts[i:j]))
                yield pa.RecordBatch.from_arrays([pa.array(f.view(np.int64)), pa.array(toxic[i:j][d].astype(np.int64))],
                                                 names=["f", "toxic"])
    totals = rows.agg(F.count("*").alias("n"), F.sum("toxic").alias("p")).first()
    n, p = totals.n, totals.p or 0
    if not p or p == n:
        return [n, p, []]
    counts = rows.mapInArrow(run, "f long, toxic long").groupBy("f").agg(
        F.count("*").alias("k"), F.sum("toxic").alias("t")).where(F.col("k") >= min_docs)
    g2 = _ratio(F.col("k").cast("double"), F.col("t").cast("double"), n, p)
    best = counts.withColumn("g2", g2).where("g2 > 10.8").orderBy(F.desc("g2"), "f").limit(max_features)
    return [n, p, [r.f for r in best.select("f").collect()]]


def neutral_terms(rows: DataFrame, size: int = FOUND_TERMS, min_docs: int = 40) -> tuple[str, ...]:
    """The most frequent words of the sample whose presence tells nothing of
    the label (log-likelihood ratio below 1): at most ``size``."""
    def run(batches):
        for b in batches:
            out = [(w, y) for t, y in zip(utf8(b.column(0)), b.column(1).to_pylist(), strict=True)
                   for w in set(_WORD.findall((t or b"").lower()))]
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in out], pa.binary()), pa.array([y for _, y in out], pa.int64())],
                                             names=["w", "toxic"])
    total = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("p")).first()
    if not total.p or total.p == total.n:
        return ()
    counts = rows.mapInArrow(run, "w binary, toxic long").groupBy("w").agg(F.count("*").alias("k"), F.sum("toxic").alias("t"))
    g2 = _ratio(F.col("k").cast("double"), F.col("t").cast("double"), total.n, total.p)
    best = counts.where((F.col("k") >= min_docs) & (g2 < 1.0)).orderBy(F.desc("k"), "w").limit(size)
    return tuple(bytes(r.w).decode() for r in best.collect())


def _matrix(rows: DataFrame, keys: np.ndarray, terms, seed: int, swaps: int):
    """(toxic, row index, feature index) of the sample and its counterfactuals
    as ``_fit`` takes them, on the driver: at most MAX_ROWS rows of known
    features and ``swaps`` counterfactuals of each."""
    def run(batches):
        swapper = _Swapper(terms, keys, seed, swaps)
        for b in batches:
            texts = utf8(b.column(0))
            for i, j in doc_groups(texts, texts):
                d, f = doc_features(texts[i:j])
                mask, place = _known(f, keys)
                all_d, all_place = d[mask], place
                d, place = _distinct(all_d, all_place)
                parts = np.split(place, np.searchsorted(d, np.arange(1, j - i)))
                order = np.argsort(all_d, kind="stable")
                own = np.split(all_place[order], np.searchsorted(all_d[order], np.arange(1, j - i)))
                changes = [swapper.changes(t, x) for t, x in zip(texts[i:j], own, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(1).slice(i, j - i), pa.array([x.astype("<i4").tobytes() for x in parts], pa.binary()),
                     pa.array(changes, pa.list_(pa.binary()))], names=["toxic", "f", "swaps"])
    got = rows.mapInArrow(run, "toxic int, f binary, swaps array<binary>").orderBy("toxic", "f", "swaps").collect()
    y = np.array([r.toxic for r in got], dtype=float)
    lists = [np.frombuffer(r.f, "<i4") for r in got]
    r = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    return y, r, np.concatenate(lists) if lists else np.zeros(0, np.int32), _gathered([x.swaps for x in got])


_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


class _Swapper:
    """Swaps terms in texts and says which known features go and come."""

    def __init__(self, terms, keys: np.ndarray, seed: int, swaps: int):
        self.lists = [[t.lower().encode() for t in group] for group in terms]
        self.place = {t: (g, k) for g, group in enumerate(self.lists) for k, t in reversed(list(enumerate(group)))}
        self.own = {}
        for group in self.lists:
            for t in group:
                _, f = doc_features([t])
                self.own[t] = np.unique(_known(f, keys)[1])
        self.seed, self.swaps = seed, swaps

    def changes(self, text: bytes | None, features: np.ndarray) -> list[bytes]:
        """One record a counterfactual: the known features that go, as -1 -
        feature, and those that come, as feature. ``features`` are the text's
        known ones, with repeats."""
        words = (text or b"").lower()
        found = [w for w in _WORD.findall(words) if w in self.place]
        if not found:
            return []
        times = {t: found.count(t) for t in set(found)}
        rng = random.Random(zlib.crc32(words) + self.seed)
        pairs = [(t, u) for t in sorted(times) for u in [None, *self.lists[self.place[t][0]]] if u != t]
        present, count = np.unique(features, return_counts=True)
        out = []
        for t, u in rng.sample(pairs, min(self.swaps, len(pairs))):
            mine = self.own[t]
            # a feature goes if no other word of the text has it
            at = np.searchsorted(present, mine)
            gone = mine[count[at] <= times[t]] if len(mine) else mine
            new = self.own[u] if u is not None else mine[:0]
            come = new[~np.isin(new, present) | np.isin(new, gone)]
            gone, come = np.setdiff1d(gone, come), np.setdiff1d(come, gone)
            out.append(np.sort(np.concatenate([-1 - gone, come])).astype("<i4").tobytes())
        return out


def _gathered(swaps: list[list[bytes]]):
    """(row, column, value, weight of each row) of the distinct changes; they
    weigh as often as they occur, together 1."""
    tally = Counter(x for each in swaps for x in each)
    records = sorted(tally)
    flat = [np.frombuffer(x, "<i4") for x in records]
    rows = np.repeat(np.arange(len(flat)), [len(x) for x in flat])
    cols = np.concatenate(flat) if flat else np.zeros(0, np.int32)
    weights = np.array([tally[x] for x in records], dtype=float)
    return rows, np.where(cols < 0, -1 - cols, cols).astype(int), np.where(cols < 0, 1.0, -1.0), weights / max(1.0, weights.sum())


def _fit(y, r, c, size, swaps, l2, pairing, steps=400) -> tuple[np.ndarray, float]:
    """Minimise mean logistic loss + l2 |w|^2 / 2 + pairing * mean squared
    counterfactual change, by accelerated gradient steps."""
    n = len(y)
    sr, sc, sv, sw = swaps
    w, bias = np.zeros(size), float(np.log((y.sum() + 1) / (n - y.sum() + 1)))
    share = np.bincount(c, minlength=size) / n
    # per-coordinate step sizes from a diagonal bound on the curvature
    per_doc = np.bincount(r, minlength=n).max() if len(r) else 1
    step = 1 / (0.25 * np.maximum(share, 1 / n) * min(per_doc, 30) + l2 + 1e-9)
    if len(sw):
        size_of = np.bincount(sr, weights=np.abs(sv), minlength=len(sw))
        curve = np.bincount(sc, weights=2 * pairing * (sw * size_of)[sr] * np.abs(sv), minlength=size)
        step = 1 / (1 / step + curve)
    v, vb, t, last = w.copy(), bias, 1.0, np.inf
    for _ in range(steps):
        logit = vb + np.bincount(r, weights=v[c], minlength=n)
        p = 1 / (1 + np.exp(-np.clip(logit, -40, 40)))
        g = np.bincount(c, weights=(p - y)[r], minlength=size) / n + l2 * v
        loss = -np.mean(np.where(y > 0, np.log(p + 1e-12), np.log(1 - p + 1e-12))) + l2 * (v @ v) / 2
        if len(sw):
            change = np.bincount(sr, weights=sv * v[sc], minlength=len(sw))
            loss += pairing * float(sw @ change ** 2)
            g += np.bincount(sc, weights=sv * (2 * pairing * sw * change)[sr], minlength=size)
        w_new, bias_new = v - step * g, vb - 2.0 * float(np.mean(p - y))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        if loss > last:  # restart the momentum
            t_new = 1.0
        m = (t - 1) / t_new
        v, vb = w_new + m * (w_new - w), bias_new + m * (bias_new - bias)
        w, bias, t, last = w_new, bias_new, t_new, loss
    return w, bias


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, max_features: int = MAX_FEATURES,
        min_docs: int = 4, l2: float = 1e-5, pairing: float = 1.0, terms=IDENTITY_TERMS, find_terms: bool = True,
        swaps: int = SWAPS, seed: int = 11,
        id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Learn from at most ``max_rows`` labelled rows (not the held-out ones).
    ``pairing`` weighs the counterfactual penalty; 0 leaves it out. ``terms``
    are the identity terms by list; ``find_terms`` adds the list found in the
    sample."""
    ship(docs.sparkSession)
    rows = stage(sample(docs, labels, max_rows, seed, id_col, text_col), "toxicity-sample")
    n, p, found = _frequencies(rows, min_docs, max_features)
    bias = float(np.log(((p or 0) + 1) / (n - (p or 0) + 1)))
    if not found:
        return Model(np.zeros(0, np.uint64), np.zeros(0), bias)
    if find_terms and pairing:
        terms = (*terms, neutral_terms(rows))
    named, _, _, _ = hash_words([t.lower().encode() for g in terms for t in g], ALNUM, True)
    keys = np.unique(np.concatenate([np.array(found, dtype=np.int64).view(np.uint64), named]))
    y, r, c, changes = _matrix(rows, keys, terms, seed, swaps if pairing else 0)
    w, bias = _fit(y, r, c, len(keys), changes, l2, pairing)
    return Model(keys, w, bias)


def score(docs: DataFrame, model: Model, text_col: str = "text") -> tuple[DataFrame, str]:
    """(docs with a score column, its name)."""
    spark = docs.sparkSession
    ship(spark)
    name, work = fresh(docs, "toxicity"), fresh(docs, "lower_text")
    shared = spark.sparkContext.broadcast(model)  # max_features values at most
    columns = docs.columns

    def run(batches):
        for b in batches:
            s = shared.value.scores(utf8(b.column(len(columns))))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(s)], names=[*columns, name])

    schema = docs.withColumn(name, F.lit(0.0)).schema
    return docs.withColumn(work, F.lower(text_col)).mapInArrow(run, schema), name


def reject(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **options) -> DataFrame:
    """``docs`` without those scored ``threshold`` or more."""
    out, name = score(docs, fit(docs, labels, **options))
    return out.where(F.col(name) < threshold).select(*docs.columns)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    out, name = score(docs.select("doc_id", "text"), fit(docs, labels))
    return out.select("doc_id", held_out().alias("held_out"), F.col(name).alias("score"),
                      (F.col(name) >= 0.7).cast("int").alias("predicted"))
