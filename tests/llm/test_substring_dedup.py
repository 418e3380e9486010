import hashlib
import random
import re

from strata.llm import substring_dedup as S


def brute(rows, k=50):
    words = {d: re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for d, t in rows}
    least = {}
    for d, w in words.items():
        for i in range(len(w) - k + 1):
            g = tuple(w[i:i + k])
            least[g] = min(d, least.get(g, d))
    out = {}
    for d, w in words.items():
        gone = [False] * len(w)
        for i in range(len(w) - k + 1):
            if least[tuple(w[i:i + k])] < d:
                gone[i:i + k] = [True] * k
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[d] = (len(w), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


def rows_of(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_cover_has_every_difference():
    assert {(a - b) % S.PERIOD for a in S.COVER for b in S.COVER} == set(range(S.PERIOD))


def test_documents(spark, docs, no_docs, small_dir):
    assert rows_of(S.digest(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert S.digest(no_docs).count() == 0
    d = spark.read.parquet(f"{small_dir}/documents.parquet")
    got = rows_of(S.digest(d))
    assert got == brute([(r.doc_id, r.text) for r in d.collect()]) and any(v[1] for v in got.values())


def test_passages_at_any_offset(spark):
    """Passages of 48 to 52 words and more, at all offsets, within larger
    texts, repeated inside one document, overlapping, and whole copies."""
    rng = random.Random(3)
    pool = [[f"p{i}w{j}" for j in range(rng.choice((48, 49, 50, 51, 52, 70, 130)))] for i in range(25)]
    rows = []
    for d in range(160):
        w = []
        for _ in range(rng.randrange(1, 5)):
            w += [f"u{rng.randrange(10**9)}" for _ in range(rng.randrange(45))]
            w += rng.choice(pool)
        rows.append((d * 37 % 1000, rng.choice((" ", "\n", "\t ")).join(w)))
    rows += [(2000 + i, rows[i % 5][1]) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert rows_of(S.digest(df)) == brute(rows)


def test_columns_and_repeated_rows(spark, docs):
    out, name = S.remove_repeats(docs.unionByName(docs))
    assert out.columns == [*docs.columns, name] and out.count() == 2 * docs.count()
