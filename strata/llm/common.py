"""Shared plumbing of the training-data operators: staged tables in the
shared folder, code shipping, prefix sums over partition totals, connected
components."""

from __future__ import annotations

import contextlib
import ctypes
import os
import tempfile
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.session import scratch_path

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_READ = "spark.sql.parquet.columnarReaderBatchSize"
_MAX_BYTES = 1 << 20
#: bytes of a batch sent to Python, where the session has Spark's default
BATCH_BYTES = 4 << 20
_BATCH, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers (once per context), as
    ``--py-files`` would, and bound the batches sent to them by bytes."""
    if spark.conf.get(_BATCH, None) in (None, _BATCH_DEFAULT):
        spark.conf.set(_BATCH, str(BATCH_BYTES))
    sc = spark.sparkContext
    if getattr(sc, "_strata_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path = os.path.join(tempfile.mkdtemp(prefix="strata-code-"), "strata_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(os.path.join(root, "strata")):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    sc._strata_shipped = True


@contextlib.contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Inside, ``key`` of the session is ``value``."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def _shuffles_removed(spark: SparkSession) -> contextlib.AbstractContextManager[None]:
    """Inside, a query's shuffle files go when it ends (its result is a
    written table, so nothing reads them again)."""
    return _setting(spark, _CLEANUP, "true")


def stage(df: DataFrame, name: str, options: dict | None = None,
          partition_by: list[str] | None = None, batch_rows: int | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: cuts the
    lineage, so a lost executor recomputes from here, and later joins start
    from fresh shuffles that adaptive execution can split. ``batch_rows`` bounds
    the rows that a task holds of a Parquet input, for long rows."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    schema = df.schema
    with contextlib.ExitStack() as inside:
        inside.enter_context(_shuffles_removed(spark))
        if batch_rows:
            inside.enter_context(_setting(spark, _READ, str(batch_rows)))
        w = df.write.mode("error").options(**(options or {}))
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
    return spark.read.schema(schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def prefix_sums(totals: DataFrame, key: str, value: str, out: str = "base") -> DataFrame:
    """(key, out): the sum of ``value`` over smaller keys. ``totals`` has one
    row per partition or bucket, so the single-task window is bounded by the
    number of partitions, not by the data."""
    w = Window.orderBy(F.col(key)).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(key, F.coalesce(F.sum(value).over(w), F.lit(0)).cast("long").alias(out))


def doc_groups(ids: list, texts: list[bytes | None], limit: int = _MAX_BYTES):
    """Slices of a batch of at most about ``limit`` bytes of text (or one
    document), to bound the temporaries of vectorised work."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t is not None else 0
        if i > start and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def utf8(column: pa.Array) -> list[bytes | None]:
    """The column's texts as UTF-8 bytes, NULL as None."""
    return column.cast(pa.binary()).to_pylist()


def fresh(df: DataFrame, base: str) -> str:
    """``base``, or a variant that no column of ``df`` uses."""
    taken = {c.lower() for c in df.columns}
    name, i = base, 0
    while name.lower() in taken:
        i += 1
        name = f"{base}_{i}"
    return name


def connected(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): the smallest id reachable over ``links``, for every id
    that occurs in them.

    Contraction: every node points to the smallest node of its closed
    neighbourhood, pointers are doubled twice, links are rewritten to the
    pointed-to nodes, until none is left between different nodes. Each step is
    a written table; the driver sees only whether links remain.
    """
    edges = links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a <> b").distinct()
    edges = stage(edges, "cc-edges")
    result: DataFrame | None = None
    while not edges.isEmpty():
        near = edges.select(F.col("b").alias("id"), F.col("a").alias("to")).unionByName(
            edges.select(F.col("a").alias("id"), F.col("a").alias("to")))
        f = stage(near.groupBy("id").agg(F.min("to").alias("to")), "cc-pointer")
        for _ in range(2):
            g = f.select(F.col("id").alias("_i"), F.col("to").alias("_t"))
            f = f.join(g, f["to"] == g["_i"], "left").select("id", F.coalesce("_t", "to").alias("to"))
        f = stage(f, "cc-pointer")
        g = f.select(F.col("id").alias("_i"), F.col("to").alias("_t"))
        if result is None:
            result = f.select("id", F.col("to").alias("component"))
        else:
            result = stage(result.join(g, result["component"] == g["_i"], "left").select(
                "id", F.coalesce("_t", "component").alias("component")), "cc-result")
        e = edges.join(g, edges["a"] == g["_i"]).select(F.col("_t").alias("a"), "b")
        e = e.join(g, e["b"] == g["_i"]).select("a", F.col("_t").alias("b"))
        e = e.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        edges = stage(e, "cc-edges")
    if result is None:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return result


def release() -> None:
    """Give freed memory back to the system, so that a worker that is used
    again doesn't keep the peak of a task it has done."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library has no such call
        ctypes.CDLL(None).malloc_trim(0)


def crc32_unsigned(data: Column) -> Column:
    return F.crc32(data).cast("long")
