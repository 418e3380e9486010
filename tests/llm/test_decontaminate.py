import hashlib
import re

import pytest

from strata.llm import decontaminate as D

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").encode().lower())


def brute(docs, items, n=13):
    grams = {}
    for item, text in items:
        w = words(text)
        k = min(n, len(w))
        for i in range(len(w) - k + 1 if w else 0):
            grams.setdefault(tuple(w[i:i + k]), set()).add(item)
    out = {}
    for d, text in docs:
        w = words(text)
        hit, found = [False] * len(w), set()
        for k in {len(g) for g in grams}:
            for i in range(len(w) - k + 1):
                g = tuple(w[i:i + k])
                if g in grams:
                    hit[i:i + k] = [True] * k
                    found |= grams[g]
        joined = ",".join(sorted(str(x) for x in found if x is not None))
        h = sum(hit)
        out[d] = (len(w), h, len(found - {None}), hashlib.sha256(joined.encode()).hexdigest(),
                  h > 0 and 20 * h >= len(w))
    return out


@pytest.fixture(scope="module")
def bench(spark):
    item = " ".join(f"b{i}" for i in range(20))
    rows = [(1, "Quick brown fox"), (2, "quick BROWN fox"), (3, None), (4, "..."), (10, item), (10, "w5 w6 w7"),
            (None, "lazy dog"), (20, item[:40])]
    rows = [(*r, "x") for r in rows]
    return spark.createDataFrame(rows, "item_id long, text string, hits string").repartition(2)


def rows_of(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_digest_equals_brute_force(spark, docs, bench, small_dir):
    src = [(r.doc_id, r.text) for r in docs.collect()]
    items = [(r.item_id, r.text) for r in bench.collect()]
    assert rows_of(D.digest(docs, bench)) == brute(src, items)
    d, b = spark.read.parquet(f"{small_dir}/documents.parquet"), spark.read.parquet(f"{small_dir}/benchmark.parquet")
    got = rows_of(D.digest(d, b))
    assert got == brute([(r.doc_id, r.text) for r in d.collect()], [(r.item_id, r.text) for r in b.collect()])
    assert any(v[4] for v in got.values())


def test_slices_give_the_same(spark, docs, bench):
    whole, name = D.annotate(docs, bench)
    parts, _ = D.annotate(docs, bench, slice_bytes=150)
    assert {str(r) for r in whole.collect()} == {str(r) for r in parts.collect()}


def test_empty_tables(spark, docs, bench, no_docs):
    assert D.digest(no_docs, bench).count() == 0
    assert {v[1] for v in rows_of(D.digest(docs, bench.limit(0))).values()} == {0}


def test_removal(spark, docs, bench):
    kept = D.remove_documents(docs, bench)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {1, 2, 3, 4, 5, 9, 11}
    texts = {r.doc_id: r.text for r in D.remove_spans(docs, bench).collect()}
    assert texts[6] == "the  jumps over a  and runs far away from it"
    assert texts[2] is None and texts[3] == "" and texts[11].startswith("it was a")
    assert texts[4] == next(r.text for r in docs.collect() if r.doc_id == 4)
