"""Benchmark decontamination by normalised word n-grams.

The benchmark's windows are hashed into a set that every task holds; tasks
slide the same windows over whole documents, look hashes up, and compare the
words of each hit. Only a benchmark slice of at most ``slice_bytes`` of text is
broadcast at a time: a larger benchmark is scanned slice by slice, each pass
adding its hits to a written table, so memory stays bounded and results are
the same.

A window is ``n`` consecutive words of an item, or all words of a shorter
item. Words are runs of letters, digits and non-ASCII characters after
lower-casing A-Z. Edge cases: NULL and empty texts have no words and no hits;
an item without words has no window; items may repeat an id or a text; an item
without an id marks words but is not listed; an empty benchmark hits nothing.
All columns of the documents pass through, and the added column takes a free
name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import doc_groups, fresh, release, ship, stage, utf8
from .words import ALNUM, covered, hash_words, windows

SLICE_BYTES = 16 << 20
_BITS = 22


class _Grams:
    """The windows of some items, by length."""

    def __init__(self, items: list[tuple[int | None, str | None]], n: int):
        raw = [(t or "").encode() for _, t in items]
        h, first, s, e = hash_words(raw, ALNUM, True)
        self.found: dict[int, dict[int, dict[bytes, set]]] = {}
        for i, (item, _) in enumerate(items):
            a, b = first[i], first[i + 1]
            if a == b:
                continue
            k = min(n, b - a)
            words = [raw[i][x:y].lower() for x, y in zip(s[a:b], e[a:b], strict=True)]
            for j, w in enumerate(windows(h[a:b], k).tolist()):
                same = self.found.setdefault(int(k), {}).setdefault(w, {})
                same.setdefault(b" ".join(words[j:j + k]), set()).add(item)
        self.seen = {}
        for k, found in self.found.items():
            bits = np.zeros(1 << _BITS, dtype=bool)
            keys = np.sort(np.fromiter(found, dtype=np.uint64, count=len(found)))
            bits[(keys >> np.uint64(64 - _BITS)).astype(np.int64)] = True
            self.seen[k] = (keys, bits)

    def hits(self, raw: list[bytes | None]):
        """Per text: (word count, covered mask or None, items, starts, ends)."""
        h, first, s, e = hash_words(raw, ALNUM, True)
        starts: dict[int, list] = {}
        for k, (keys, bits) in self.seen.items():
            w = windows(h, k)
            at = np.flatnonzero(bits[(w >> np.uint64(64 - _BITS)).astype(np.int64)])
            where = np.searchsorted(keys, w[at])
            at = at[keys[np.minimum(where, len(keys) - 1)] == w[at]]
            doc = np.searchsorted(first, at, side="right") - 1
            inside = at + k <= first[doc + 1]
            for p, d in zip(at[inside].tolist(), doc[inside].tolist(), strict=True):
                text = raw[d]
                words = b" ".join([text[x:y].lower() for x, y in zip(s[p:p + k], e[p:p + k], strict=True)])
                items = self.found[k][int(w[p])].get(words)
                if items is not None:
                    starts.setdefault(d, []).append((p - int(first[d]), k, items))
        for d in range(len(raw)):
            a, b = first[d], first[d + 1]
            mask, items = None, set()
            for k in sorted({x[1] for x in starts.get(d, ())}):
                part = covered(b - a, np.array([x[0] for x in starts[d] if x[1] == k]), k)
                mask = part if mask is None else mask | part
            for x in starts.get(d, ()):
                items |= x[2]
            yield int(b - a), mask, items, s[a:b], e[a:b]


def _runs(mask: np.ndarray) -> list[tuple[int, int]]:
    step = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return list(zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist(), strict=True))


def _slices(benchmark: DataFrame, item_col: str, text_col: str, slice_bytes: int):
    """Items in slices of at most ``slice_bytes`` of text (or one item each)."""
    b = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(text_col).alias("body"))
    b = b.withColumn("size", F.coalesce(F.octet_length("body"), F.lit(0)).cast("long") + 64)
    total = b.agg(F.sum("size")).first()[0] or 0
    if total <= slice_bytes:
        yield [(r.item, r.body) for r in b.collect()]
        return
    order = Window.orderBy("item", "body").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    b = stage(b.withColumn("slice", F.floor(F.sum("size").over(order) / slice_bytes)), "benchmark-slices")
    for k in sorted(r[0] for r in b.select("slice").distinct().collect()):
        yield [(r.item, r.body) for r in b.where(F.col("slice") == k).collect()]


def annotate(docs: DataFrame, benchmark: DataFrame, n: int = 13, slice_bytes: int = SLICE_BYTES,
             text_col: str = "text", item_col: str = "item_id", bench_text_col: str = "text") -> tuple[DataFrame, str]:
    """(docs with one more column, its name): a struct (n_words, items, words,
    bytes); ``items`` are the ids with occurring windows, ``words`` and
    ``bytes`` the hit runs as half-open word and UTF-8 byte spans."""
    spark = docs.sparkSession
    ship(spark)
    name = fresh(docs, "hits")
    span = "array<struct<`from`: long, `to`: long>>"
    kind = f"struct<n_words: long, items: array<long>, words: {span}, bytes: {span}>"
    arrow_span = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
    arrow = pa.struct([("n_words", pa.int64()), ("items", pa.list_(pa.int64())),
                       ("words", arrow_span), ("bytes", arrow_span)])
    columns, at = docs.columns, docs.columns.index(text_col)
    out = docs.withColumn(name, F.lit(None).cast(kind))
    schema = out.schema
    for k, items in enumerate(_slices(benchmark, item_col, bench_text_col, slice_bytes)):
        shared = spark.sparkContext.broadcast(items)

        def run(batches, shared=shared):
            grams = _Grams(shared.value, n)
            for b in batches:
                texts = utf8(b.column(at))
                for i, j in doc_groups(texts, texts):
                    before = b.column(len(columns)).slice(i, j - i).to_pylist()
                    rows = []
                    for old, (words, mask, found, s, e) in zip(before, grams.hits(texts[i:j]), strict=True):
                        if old and old["words"]:  # hits of earlier slices
                            mask = np.zeros(words, dtype=bool) if mask is None else mask
                            for r in old["words"]:
                                mask[r["from"]:r["to"]] = True
                            found = found | set(old["items"])
                        runs = _runs(mask) if mask is not None else []
                        rows.append({"n_words": words, "items": sorted(x for x in found if x is not None),
                                     "words": [{"from": x, "to": y} for x, y in runs],
                                     "bytes": [{"from": int(s[x]), "to": int(e[y - 1])} for x, y in runs]})
                    yield pa.RecordBatch.from_arrays(
                        [c.slice(i, j - i) for c in b.columns[:-1]] + [pa.array(rows, arrow)],
                        names=[*columns, name])
            release()
        out = (stage(out, "decontaminate") if k else out).mapInArrow(run, schema)
    return out, name


def n_hit(name: str):
    return F.aggregate(F.col(name)["words"], F.lit(0).cast("long"), lambda s, x: s + x["to"] - x["from"])


def contaminated(name: str, share: int = 20):
    """Hit words make up at least 1 / share of the document's words."""
    return (n_hit(name) > 0) & (n_hit(name) * share >= F.col(name)["n_words"])


def remove_documents(docs: DataFrame, benchmark: DataFrame, share: int = 20, **options) -> DataFrame:
    """``docs`` without the contaminated ones."""
    out, name = annotate(docs, benchmark, **options)
    return out.where(~contaminated(name, share)).select(*docs.columns)


def remove_spans(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` with the hit spans cut out of the texts."""
    out, name = annotate(docs, benchmark, text_col=text_col, **options)
    raw, spans = F.col(text_col).cast("binary"), F.col(name)["bytes"]
    # the stretch before each span, then what follows the last one
    begins = F.concat(F.array(F.lit(0).cast("long")), F.transform(spans, lambda x: x["to"]))
    ends = F.concat(F.transform(spans, lambda x: x["from"]), F.array(F.octet_length(raw).cast("long")))
    keep = F.aggregate(
        F.arrays_zip(begins.alias("b"), ends.alias("e")), F.lit(b""),
        lambda s, x: F.concat(s, F.substring(raw, (x["b"] + 1).cast("int"), (x["e"] - x["b"]).cast("int"))))
    text = F.when(F.size(spans) > 0, keep.cast("string")).otherwise(F.col(text_col))
    return out.withColumn(text_col, text).select(*docs.columns)


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    out, name = annotate(docs.select("doc_id", "text"), benchmark)
    items = F.col(name)["items"]
    joined = F.concat_ws(",", F.array_sort(F.transform(items, lambda x: x.cast("string"))))
    return out.select("doc_id", F.col(name)["n_words"].alias("n_words"), n_hit(name).alias("n_hit"),
                      F.size(items).cast("long").alias("n_items"), F.sha2(joined, 256).alias("items_sha256"),
                      contaminated(name).alias("contaminated"))
