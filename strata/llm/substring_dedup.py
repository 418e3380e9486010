"""Exact removal of passages that repeat across documents, by difference-cover
anchors.

A document's words at positions p with p mod 31 in a difference cover start an
anchor window of 20 words. Whatever the offset between two equal passages of
50 words, some position in their first 31 words is a cover position in both,
so they share an anchor. Anchors seen in two documents or more are extended:
only the 50-word windows around them are hashed and compared. A window counts
as repeated if a document with a smaller id holds it too; the words it covers
are removed.

Documents with the same words form a class up front: all but the smallest id
lose every window at once, so a large group of copies costs its own size only.
Per window hash, only the smallest id is kept (a partial aggregate), and joins
start from written tables, which adaptive execution can split at hot hashes.

Words are compared through 64-bit window hashes (128 bits for whole
documents). Edge cases: NULL and blank texts have no words; texts under
``length`` words lose nothing; rows sharing an id are one document, and where
their texts differ, a window marked in one is marked at the same place of the
others; a NULL id is never smaller than another; no documents give no rows;
further columns pass through or are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_groups, fresh, ship, stage, utf8
from .words import NON_SPACE, covered, hash_words, mix, windows

PERIOD = 31
#: every difference modulo PERIOD occurs between two of these
COVER = (1, 5, 11, 24, 25, 27)
_IS_COVER = np.isin(np.arange(PERIOD), COVER)


def anchor_places(n: int, width: int) -> np.ndarray:
    """Starts of the anchor windows in a text of n words."""
    p = np.arange(max(0, n - width + 1))
    return p[_IS_COVER[p % PERIOD]]


def near_windows(n: int, anchors: np.ndarray, length: int) -> np.ndarray:
    """Starts of the windows that hold one of the anchors in their first
    PERIOD places."""
    reach = np.zeros(n + 1, dtype=bool)
    for k in range(PERIOD):
        at = anchors - k
        reach[at[at >= 0]] = True
    return np.flatnonzero(reach[:max(0, n - length + 1)])


def _anchored(docs: DataFrame, length: int) -> DataFrame:
    """Written table (doc_id, whole, n_words, anchors): ``whole`` is a 128-bit
    hash of the word sequence, anchors are (hash, position)."""
    width = length - PERIOD + 1

    def run(batches):
        for b in batches:
            texts = utf8(b.column(1))
            for i, j in doc_groups(texts, texts):
                h, first, _, _ = hash_words(texts[i:j], NON_SPACE, False)
                whole, places, hashes = [], [], []
                for x, y in zip(first[:-1], first[1:], strict=True):
                    w, n = h[x:y], y - x
                    turn = mix(np.arange(n, dtype=np.uint64))
                    whole.append(np.array([mix(w ^ turn).sum(), mix(w + turn).sum(), n], "<u8").tobytes())
                    p = anchor_places(n, width) if n >= length else np.zeros(0, np.int64)
                    places.append(p)
                    hashes.append(windows(w, width)[p] if len(p) else h[:0])
                flat = pa.StructArray.from_arrays(
                    [pa.array(np.concatenate(hashes).view(np.int64)), pa.array(np.concatenate(places).astype(np.int32))],
                    names=["h", "p"])
                at = np.cumsum([0] + [len(p) for p in places]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array(whole, pa.binary()), pa.array(np.diff(first)),
                     pa.ListArray.from_arrays(pa.array(at), flat)], names=["doc_id", "whole", "n_words", "anchors"])

    return stage(docs.mapInArrow(run, "doc_id long, whole binary, n_words long, anchors array<struct<h: long, p: int>>"),
                 "substring-anchors")


def _window_rows(docs: DataFrame, length: int) -> DataFrame:
    """(w, doc_id, p) of the windows around the shared anchors of (doc_id,
    text, places)."""
    def run(batches):
        for b in batches:
            texts, places = utf8(b.column(1)), b.column(2)
            for i, j in doc_groups(texts, texts):
                h, first, _, _ = hash_words(texts[i:j], NON_SPACE, False)
                ids, ws, ps = [], [], []
                for d, (x, y) in enumerate(zip(first[:-1], first[1:], strict=True)):
                    at = places[i + d].values.to_numpy()
                    p = near_windows(y - x, at[at < y - x], length)
                    if len(p):
                        ids.append(np.full(len(p), i + d))
                        ps.append(p.astype(np.int32))
                        ws.append(windows(h[x:y], length)[p])
                if ids:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(ws).view(np.int64)), b.column(0).take(pa.array(np.concatenate(ids))),
                         pa.array(np.concatenate(ps))], names=["w", "doc_id", "p"])

    return docs.mapInArrow(run, "w long, doc_id long, p int")


def marks(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, starts, copy): for every document with removals, the starts of
    its repeated windows, or ``copy`` where all its words repeat a smaller
    document's."""
    if length <= PERIOD:
        raise ValueError(f"length must be over {PERIOD}")
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = _anchored(rows, length)
    long = found.where(F.col("n_words") >= length)
    classes = stage(long.groupBy("whole").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last")).where(
        "rep < last"), "substring-classes")
    copies = stage(long.select("doc_id", "whole").join(classes, "whole").where("doc_id > rep").select(
        "doc_id").distinct(), "substring-copies")
    anchors = long.join(copies, "doc_id", "left_anti").select("doc_id", F.explode("anchors").alias("a")).select(
        "doc_id", F.col("a.h").alias("h"), F.col("a.p").alias("p"))
    shared = stage(anchors.groupBy("h").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where(
        "lo < hi").select("h"), "substring-shared")
    places = stage(anchors.join(shared, "h").groupBy("doc_id").agg(F.collect_list("p").alias("places")),
                   "substring-places")
    near = rows.join(places, "doc_id").select("doc_id", "text", "places")
    wins = stage(_window_rows(near, length), "substring-windows")
    least = stage(wins.groupBy("w").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where(
        "lo < hi").select("w", "lo"), "substring-least")
    hit = wins.join(least, "w").where(F.col("doc_id") > F.col("lo"))
    starts = hit.groupBy("doc_id").agg(F.collect_list("p").alias("starts"))
    return stage(starts.withColumn("copy", F.lit(False)).unionByName(
        copies.select("doc_id", F.lit(None).cast("array<int>").alias("starts"), F.lit(True).alias("copy"))),
        "substring-marks")


def remove_repeats(docs: DataFrame, length: int = 50, id_col: str = "doc_id",
                   text_col: str = "text") -> tuple[DataFrame, str]:
    """(docs with one more column, its name): a struct (n_words, n_removed,
    kept); ``kept`` is the words that stay, joined by single spaces."""
    found = marks(docs, length, id_col, text_col)
    name = fresh(docs, "repeats")
    found = found.select(F.col("doc_id").alias("_marked"), F.struct("starts", "copy").alias(name))
    out = docs.join(found, docs[id_col] == found["_marked"], "left").drop("_marked")
    columns, at = docs.columns, docs.columns.index(text_col)
    kind = pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])

    def kept(text: bytes | None, mark: pa.StructScalar) -> dict:
        words = (text or b"").split()  # bytes split at ASCII white space
        n = len(words)
        gone = np.zeros(n, dtype=bool)
        if mark.is_valid and mark["copy"].as_py():
            gone[:] = n >= length
        elif mark.is_valid:
            starts = mark["starts"].values.to_numpy()
            gone = covered(n, starts[starts + length <= n], length)
        if gone.any():
            words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
        return {"n_words": n, "n_removed": int(gone.sum()), "kept": b" ".join(words).decode()}

    def run(batches):
        for b in batches:
            raw = utf8(b.column(at))
            for i, j in doc_groups(raw, raw):
                values = [kept(t, m) for t, m in zip(raw[i:j], b.column(len(columns)).slice(i, j - i), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [c.slice(i, j - i) for c in b.columns[:-1]] + [pa.array(values, kind)], names=[*columns, name])

    schema = docs.withColumn(name, F.lit(None).cast("struct<n_words: long, n_removed: long, kept: string>")).schema
    return out.mapInArrow(run, schema), name


def digest(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256)."""
    out, name = remove_repeats(docs.select("doc_id", "text"))
    return out.select("doc_id", F.col(name)["n_words"].alias("n_words"), F.col(name)["n_removed"].alias("n_removed"),
                      F.sha2(F.col(name)["kept"], 256).alias("kept_sha256"))
