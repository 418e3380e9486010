"""Token ids as Parquet files: a list column of ids beside its metadata, in
ascending doc_id order.

Files are range-partitioned and sorted by doc_id. Row group and page sizes are
parameters; the writer adds page indexes, so a filter on doc_id reads only the
pages it needs, and metadata columns are read without the ids. Ids are
delta-encoded (version 2 pages) or dictionary-encoded.

Edge cases: a NULL text is an empty one (one end id); NULL ids come first;
documents sharing an id are ordered by text; no documents give no rows;
further columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import _shuffles_removed, doc_groups, prefix_sums, ship
from .packing import BROADCAST_PARTITIONS
from .tokens import GROUP_BYTES, encoder, no_cycles

_SCHEMA = "part int, doc_id long, at long, n_tokens long, ids array<int>"
_ARROW = pa.schema([("part", pa.int32()), ("doc_id", pa.int64()), ("at", pa.int64()),
                    ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))])


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, encoding: str = "delta",
                 row_group_bytes: int = 16 << 20, page_rows: int = 500, page_bytes: int = 256 << 10,
                 partitions: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Write ``docs`` below ``path``; returns ``path``."""
    spark = docs.sparkSession
    ship(spark)
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches):
        part, at, encode = TaskContext.get().partitionId(), 0, encoder(tokenizer)
        with no_cycles():
            for b in batches:
                ids, texts = b.column(0), b.column(1).to_pylist()
                for i, j in doc_groups(ids, texts, GROUP_BYTES):
                    coded = [x + end for x in encode(texts[i:j])]
                    n = np.array([len(x) // 4 for x in coded], dtype=np.int64)
                    starts = at + np.cumsum(n) - n
                    at += int(n.sum())
                    values = pa.array(np.frombuffer(b"".join(coded), "<i4"))
                    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), values)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(j - i, part, np.int32)), ids.slice(i, j - i), pa.array(starts),
                         pa.array(n), lists], schema=_ARROW)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.repartitionByRange(partitions, F.col("doc_id").asc_nulls_first())
    rows = rows.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
    options = {"compression": "zstd", "parquet.compression.codec.zstd.level": 1, "parquet.block.size": row_group_bytes, "parquet.page.size": page_bytes,
               "parquet.page.row.count.limit": page_rows,
               "parquet.enable.dictionary": "true" if encoding == "dictionary" else "false",
               "parquet.writer.version": "v1" if encoding == "dictionary" else "v2"}
    with _shuffles_removed(spark):
        rows.mapInArrow(run, _SCHEMA).write.options(**options).parquet(path)
    return path


def read_tokens(spark: SparkSession, path: str, doc_ids: tuple[int, int] | None = None,
                columns: list[str] | None = None) -> DataFrame:
    """Rows of the files, optionally of an inclusive doc_id range and only
    some columns; both reach the Parquet scan."""
    t = spark.read.schema(_SCHEMA).parquet(path)
    if doc_ids:
        t = t.where(F.col("doc_id").between(*doc_ids))
    return t.select(*columns) if columns else t


def with_starts(rows: DataFrame, spark: SparkSession, path: str) -> DataFrame:
    """``rows`` (holding part and at) with ``start``: ids of all documents
    before; totals come from the metadata columns."""
    totals = read_tokens(spark, path, columns=["part", "n_tokens"]).groupBy("part").agg(
        F.sum("n_tokens").alias("total"))
    base = prefix_sums(totals, "part", "total")
    if totals.count() <= BROADCAST_PARTITIONS:  # one small row a file
        base = F.broadcast(base)
    return rows.join(base, "part").withColumn("start", F.col("base") + F.col("at")).drop("base")


def token_digest(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) as read back from the files."""
    ship(spark)
    schema = "part int, doc_id long, at long, n_tokens long, ids_crc32 long"

    def run(batches):
        for b in batches:
            lists = b.column(4)
            at = np.asarray(lists.offsets).astype(np.int64) * 4
            raw = np.ascontiguousarray(np.asarray(lists.values)).astype("<u4", copy=False).view(np.uint8)
            crc = [zlib.crc32(raw[i:j]) for i, j in zip(at[:-1], at[1:], strict=True)]
            n = np.diff(at) // 4
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(n), pa.array(crc, pa.int64())],
                names=["part", "doc_id", "at", "n_tokens", "ids_crc32"])

    rows = read_tokens(spark, path).mapInArrow(run, schema)
    return with_starts(rows, spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")
