import pathlib
import zlib
from collections import Counter

import pyarrow.parquet as pq

from strata.llm import sharding as S
from strata.session import scratch_path


def check(got, src, shards):
    n = len(src)
    counts = Counter(r.shard for r in got)
    assert sum(counts.values()) == n and max(counts.values()) - min(n // shards, *counts.values()) <= 1
    for s, c in counts.items():
        assert sorted(r.slot for r in got if r.shard == s) == list(range(c))


def test_digest(spark, docs, no_docs, small_dir):
    for d in (docs, spark.read.parquet(f"{small_dir}/documents.parquet")):
        got, src = S.digest(d).collect(), d.collect()
        check(got, src, 24)
        want = Counter((r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in src)
        assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
        assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}
    assert S.digest(no_docs).count() == 0


def test_many_buckets_shuffled_and_stable(spark):
    rows = spark.range(5000).selectExpr("id as doc_id", "repeat('x', int(id % 50)) as text", "id as slot", "1 as shard")
    rows = rows.unionByName(rows.limit(0)).repartition(7)
    path = scratch_path(spark, "sh")
    one, shard, slot = S.write_shards(rows, path, 10, bucket_bytes=9000)
    two, _, _ = S.write_shards(rows.repartition(3), scratch_path(spark, "sh"), 10, bucket_bytes=9000)
    a = {r.doc_id: (r[shard], r[slot]) for r in one.collect()}
    assert a == {r.doc_id: (r[shard], r[slot]) for r in two.collect()}
    assert (shard, slot) == ("shard_1", "slot_1") and len(a) == 5000
    assert Counter(s for s, _ in a.values()) == {s: 500 for s in range(10)}
    order = sorted(a, key=a.get)
    assert sum(y - x == 1 for x, y in zip(order, order[1:], strict=False)) < 20
    files = sorted(pathlib.Path(path.removeprefix("file:"), "shard_1=3").glob("*.parquet"))
    slots = [x for f in files for x in pq.read_table(f)["slot_1"].to_pylist()]
    assert slots == list(range(500))


def test_repeated_rows(spark, docs):
    many = docs.unionByName(docs).unionByName(docs)
    check(S.digest(many).collect(), many.collect(), 24)
