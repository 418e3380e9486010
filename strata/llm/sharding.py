"""Globally shuffled shards by a two-pass external shuffle.

Pass one scatters rows uniformly into buckets of about ``bucket_bytes`` with a
seeded hash; pass two shuffles each bucket (Fisher-Yates over its row numbers)
and writes it. Buckets follow each other in one global order, and prefix sums
over the bucket counts give every row its global position; shards are equal
stretches of it, so their row counts differ by at most one (law ``rows``).

A task holds one bucket's permutation (8 bytes a row); its rows stay in
Spark's sorter, which spills, so a bucket of long texts fits too. Seeds, hashes
and sort orders are fixed, so a repeated task writes the same rows.

Edge cases: NULL texts have no bytes; a NULL id is spread by its text; equal
rows may swap places with each other only; fewer rows than shards leave some
empty; no rows write none. All columns are written; the added ones take free
names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import scratch_path

from .common import crc32_unsigned, fresh, prefix_sums, ship, stage

#: totals of more buckets than this are joined without a broadcast
BROADCAST_BUCKETS = 1 << 20


def row_bytes(text_col: str = "text"):
    return F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + 8


def write_shards(docs: DataFrame, path: str, shards: int = 24, seed: int = 17, bucket_bytes: int = 32 << 20,
                 id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, str, str]:
    """Write ``docs`` shuffled below ``path``, one folder a shard with files in
    slot order. Returns (the rows read back with shard and slot, the names of
    these two columns)."""
    spark = docs.sparkSession
    ship(spark)
    shard, slot = fresh(docs, "shard"), fresh(docs, "slot")
    bucket, place, count, base = (fresh(docs, f"_{x}") for x in ("bucket", "place", "count", "base"))
    total = docs.agg(F.sum(row_bytes(text_col)).alias("b"), F.count("*").alias("n")).first()
    n, buckets = total.n, max(1, -(-(total.b or 0) // bucket_bytes))
    schema = docs.withColumn(slot, F.lit(0).cast("long")).withColumn(shard, F.lit(0)).schema
    if not n:
        return spark.createDataFrame([], schema), shard, slot

    key = F.pmod(F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)), F.lit(buckets)).cast("int")
    scattered = docs.withColumn(bucket, key)
    totals = stage(scattered.groupBy(bucket).agg(F.count("*").alias(count)), "shard-buckets")
    totals = totals.join(prefix_sums(totals, bucket, count, base), bucket)
    totals = F.broadcast(totals) if buckets <= BROADCAST_BUCKETS else totals  # one small row a bucket
    rows = scattered.join(totals, bucket).repartitionById(buckets, F.col(bucket))
    rows = rows.sortWithinPartitions(bucket, id_col, text_col).select(*docs.columns, bucket, count, base)
    names = [*docs.columns, place]
    at = len(docs.columns)

    def shuffle(batches):
        current, order, done = None, None, 0
        for b in batches:
            which, counts, bases = (b.column(at + k).to_numpy() for k in range(3))
            out = np.empty(b.num_rows, dtype=np.int64)
            i = 0
            while i < b.num_rows:
                if which[i] != current:
                    current, done = which[i], 0
                    order = np.random.default_rng([seed, int(current)]).permutation(int(counts[i]))
                j = i + min(int(np.searchsorted(which[i:], current, side="right")), len(order) - done)
                out[i:j] = bases[i] + order[done:done + j - i]
                done, i = done + j - i, j
            yield pa.RecordBatch.from_arrays([*b.columns[:at], pa.array(out)], names=names)

    placed = rows.mapInArrow(shuffle, docs.withColumn(place, F.lit(0).cast("long")).schema)
    placed = placed.withColumn(shard, F.expr(f"int(((`{place}` + 1) * {shards} - 1) div {n})"))
    placed = placed.withColumn(slot, F.expr(f"`{place}` - (`{shard}` * {n}L) div {shards}")).drop(place)
    placed.sortWithinPartitions(shard, slot).write.partitionBy(shard).parquet(path)
    return spark.read.schema(schema).parquet(path), shard, slot


def digest(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of the rows
    as read back from the shards."""
    path = scratch_path(docs.sparkSession, "shards")
    out, shard, slot = write_shards(docs, path)
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return out.select("doc_id", row_bytes().alias("size"), crc32_unsigned(text).alias("text_crc32"),
                      F.lit("rows").alias("law"), F.col(shard).alias("shard"), F.col(slot).alias("slot"),
                      F.lit(None).cast("int").alias("grown_shard"))
