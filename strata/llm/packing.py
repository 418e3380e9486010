"""Packing by concatenate and cut.

Pass one tokenizes each partition and keeps token totals; prefix sums over the
partition totals give every document its global offset; pass two cuts the
stream into windows of ``length`` ids and writes them. Whole sequences are put
together inside a task, so their tokens are not shuffled; only the boundary
records, one or two where a task's stretch of the stream begins and ends, meet
those of its neighbours. ``pieces`` are read back from the written sequences.

Edge cases: a NULL text is an empty one (one end id); a NULL or repeated
doc_id is packed like any other; no documents give no pieces; columns other
than the id and text are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc32_unsigned, doc_groups, prefix_sums, release, ship, stage
from .tokens import GROUP_BYTES, encoder, no_cycles

#: totals of more partitions than this are joined without a broadcast
BROADCAST_PARTITIONS = 1 << 20
#: bound of each generation of remembered pieces: the workers share the memory of their executor
CACHE_BYTES = 32 << 20
#: rows that are read at once: texts and ids are long
READ_ROWS = 512
#: of tables that hold ids: small row groups, as they are held until they are full
_WRITE = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1", "parquet.block.size": str(16 << 20),
          "parquet.enable.dictionary#ids": "false"}

_TOKENS = pa.schema([("part", pa.int32()), ("at", pa.int64()), ("doc_id", pa.int64()),
                     ("n", pa.int64()), ("ids", pa.binary())])


def _coded(batches, part: int, encode, end: bytes):
    """Batches of ``_TOKENS`` for batches of (id, text) of a partition."""
    at = 0
    for b in batches:
        ids, texts = b.column(0), b.column(1).to_pylist()
        for i, j in doc_groups(ids, texts, GROUP_BYTES):
            coded = [x + end for x in encode(texts[i:j])]
            n = np.array([len(x) // 4 for x in coded], dtype=np.int64)
            starts = at + np.cumsum(n) - n
            at += int(n.sum())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(j - i, part, np.int32)), pa.array(starts), ids.slice(i, j - i),
                 pa.array(n), pa.array(coded, pa.binary())], schema=_TOKENS)


def tokenize(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """Written table (part, at, doc_id, n, ids): ids as little-endian unsigned
    32-bit values with ``end_id`` at the end; ``at`` counts the ids before the
    document in its partition."""
    ship(docs.sparkSession)
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches):
        with no_cycles():
            yield from _coded(batches, TaskContext.get().partitionId(), encoder(tokenizer, cache_bytes=CACHE_BYTES), end)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "part int, at long, doc_id long, n long, ids binary")
    return stage(rows, "tokens", _WRITE, batch_rows=READ_ROWS)


def offsets(tokens: DataFrame) -> DataFrame:
    """``tokens`` with ``begin``, each document's global offset."""
    totals = tokens.groupBy("part").agg(F.sum("n").alias("total"))
    base = prefix_sums(totals, "part", "total")
    if totals.count() <= BROADCAST_PARTITIONS:  # one small row a partition
        base = F.broadcast(base)
    return tokens.join(base, "part").withColumn("begin", F.col("base") + F.col("at")).drop("base")


_PIECE = pa.struct([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()),
                    ("offset", pa.int64())])
_RECORDS = ("sequence_id long, first long, n long, ids binary, pieces array<struct<doc_id: long, start: long, "
            "length: long, doc_tokens: long, offset: long>>")


class _Stretch:
    """A stretch of the stream that is being cut: its first global place, its
    ids and, per document in it, (global begin, doc_id, ids in all)."""

    def __init__(self, length: int):
        self.length, self.at, self.raw = length, 0, b""
        self.begin = self.total = np.zeros(0, np.int64)
        self.doc = pa.array([], pa.int64())

    def end(self) -> int:
        return self.at + len(self.raw) // 4

    def add(self, begin: np.ndarray, doc: pa.Array, total: np.ndarray, raw: list[bytes]) -> None:
        """The documents that follow without a gap."""
        if not self.raw:
            self.at = int(begin[0])
        self.raw = b"".join([self.raw, *raw])
        self.begin, self.total = np.concatenate([self.begin, begin]), np.concatenate([self.total, total])
        self.doc = pa.concat_arrays([self.doc, doc])

    def cut(self, whole: bool) -> pa.RecordBatch | None:
        """Records of all windows, or of those that are complete."""
        until = self.end() if whole else self.end() // self.length * self.length
        if until <= self.at:
            return None
        first = np.unique(np.concatenate([[self.at], np.arange(-(-self.at // self.length) * self.length, until, self.length)]))
        last = np.append(first[1:], until)
        place = np.unique(np.concatenate([first, self.begin[(self.begin >= self.at) & (self.begin < until)]]))
        size = np.append(place[1:], until) - place
        doc = np.searchsorted(self.begin, place, side="right") - 1
        pieces = pa.StructArray.from_arrays(
            [self.doc.take(pa.array(doc)), pa.array(place - self.begin[doc]), pa.array(size), pa.array(self.total[doc]),
             pa.array(place % self.length)], fields=list(_PIECE))
        lists = pa.ListArray.from_arrays(pa.array(np.append(np.searchsorted(place, first), len(place)).astype(np.int32)), pieces)
        bounds = zip((4 * (first - self.at)).tolist(), (4 * (last - self.at)).tolist(), strict=True)
        out = pa.RecordBatch.from_arrays(
            [pa.array(first // self.length), pa.array(first % self.length), pa.array(last - first),
             pa.array([self.raw[i:j] for i, j in bounds], pa.binary()), lists],
            names=["sequence_id", "first", "n", "ids", "pieces"])
        keep = int(np.searchsorted(self.begin, until, side="right")) - 1  # the document that goes on
        self.raw, self.at = self.raw[4 * (until - self.at):], until
        self.begin, self.total, self.doc = self.begin[keep:], self.total[keep:], self.doc.slice(keep)
        return out


def sequences(tokens: DataFrame, length: int = 1024, pad_id: int = 0) -> DataFrame:
    """Written tables of (sequence_id, n_tokens, ids, pieces): ``ids`` binary as
    in ``tokenize``; ``pieces`` (doc_id, start, length, doc_tokens, offset)
    in order. Only the last sequence can be short; it is padded with ``pad_id``
    to ``length`` unless its size is a power of two."""

    def run(batches):
        release()  # what encoding has left in a worker that is used again
        held = _Stretch(length)
        for b in batches:
            begin, n = b.column(0).to_numpy(), b.column(2).to_numpy()
            raw = b.column(3).to_pylist()
            cuts = [0, *(np.flatnonzero(begin[1:] != begin[:-1] + n[:-1]) + 1).tolist(), len(begin)]
            for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                if j > i:
                    if held.raw and held.end() != begin[i]:  # another stretch of the stream
                        yield held.cut(True)
                        held = _Stretch(length)
                    held.add(begin[i:j], b.column(1).slice(i, j - i), n[i:j], raw[i:j])
                    if (out := held.cut(False)) is not None:
                        yield out
        if held.raw:
            yield held.cut(True)

    rows = offsets(tokens).select("begin", "doc_id", "n", "ids")
    records = stage(rows.mapInArrow(run, _RECORDS), "sequence-records", _WRITE, batch_rows=READ_ROWS)
    parts = F.array_sort(F.collect_list(F.struct("first", "n", "ids", "pieces")))
    rest = records.where(F.col("n") < length).groupBy("sequence_id").agg(parts.alias("r"))  # boundary records
    n, ids = F.col("n_tokens"), F.col("ids")
    pad = F.substring(F.lit(np.full(length, pad_id, "<u4").tobytes()), F.lit(1), ((length - n) * 4).cast("int"))
    rest = rest.select(
        "sequence_id", F.aggregate("r", F.lit(0).cast("long"), lambda s, x: s + x["n"]).alias("n_tokens"),
        F.aggregate("r", F.lit(b""), lambda s, x: F.concat(s, x["ids"])).alias("ids"),
        F.flatten(F.col("r.pieces")).alias("pieces"))
    rest = stage(rest.withColumn("ids", F.when(n.bitwiseAND(n - 1) == 0, ids).otherwise(F.concat(ids, pad))), "sequence-ends")
    whole = records.where(F.col("n") == length).select("sequence_id", F.col("n").alias("n_tokens"), "ids", "pieces")
    return whole.unionByName(rest)


def id_arrays(packed: DataFrame) -> DataFrame:
    """``sequences`` with ``ids`` as array<int> and ``doc_ids``."""
    def run(batches):
        for b in batches:
            raw = b.column(2).to_pylist()
            values = pa.array(np.frombuffer(b"".join(raw), "<i4"))
            at = np.cumsum([0, *(len(x) // 4 for x in raw)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.ListArray.from_arrays(pa.array(at), values), b.column(3)],
                names=["sequence_id", "n_tokens", "ids", "doc_ids"])
    ship(packed.sparkSession)
    return packed.select("sequence_id", "n_tokens", "ids", F.col("pieces.doc_id").alias("doc_ids")).mapInArrow(
        run, "sequence_id long, n_tokens long, ids array<int>, doc_ids array<long>")


def pieces(packed: DataFrame) -> DataFrame:
    """One row per piece of written sequences: (doc_id, start, length, ids,
    doc_tokens, sequence_id, offset); ``ids`` is binary as in ``tokenize``."""
    one = F.col("piece")
    return packed.select("sequence_id", "ids", F.explode("pieces").alias("piece")).select(
        one["doc_id"].alias("doc_id"), one["start"].alias("start"), one["length"].alias("length"),
        F.substring("ids", (one["offset"] * 4 + 1).cast("int"), (one["length"] * 4).cast("int")).alias("ids"),
        one["doc_tokens"].alias("doc_tokens"), "sequence_id", one["offset"].alias("offset"))


def piece_digest(parts: DataFrame) -> DataFrame:
    return parts.select("doc_id", "start", "length", crc32_unsigned(F.col("ids")).alias("ids_crc32"),
                        "doc_tokens", "sequence_id", "offset")
