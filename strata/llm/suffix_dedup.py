"""Exact removal of repeated byte strings by a range-partitioned sparse suffix
array.

A byte goes if a string of ``length`` bytes that covers it also starts earlier
(smaller doc_id, or the same document and an earlier start). Sorting every
suffix is out of proportion, so suffixes are sorted only where equal strings
are sure to meet: at the smallest hash of ``token`` bytes within a window of
``length`` bytes (ties to the left). Equal windows choose the same place, so
about one suffix in 32 stands for all windows that chose it.

A suffix's leading token is the hash of its first ``token`` bytes; the next one
is a hash of all bytes of its windows. Sampled splitters range-partition the
suffixes by leading tokens, document and place, so that a run of one token,
however hot, spreads over many buckets. Each bucket is sorted by multikey
quicksort (a column only among rows tied on the ones before) and neighbours
are compared: of suffixes equal in both tokens all but the earliest lose their
windows at once; the earliest of different ones with one leading token are
cut finer, into blocks of ``BLOCK`` windows and at last single windows, and
sorted again. Across boundaries, each bucket reports its first run, to be
compared with the ends of the buckets before it.

Strings are equal if two independent 64-bit hashes are. Edge cases: a NULL or
empty text has no bytes; texts under ``length`` bytes lose nothing; rows that
share an id are one document, so equal places of repeated rows are not earlier
than one another; a NULL id comes after all others; no documents give no rows;
other columns are ignored. Long texts are scanned in overlapping parts.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, stage, utf8
from .words import _Powers, mix

LENGTH = 100
TOKEN = 32
#: windows of a suffix that are compared together when it is cut finer
BLOCK = 8
#: bytes scanned at a time
PART = 1 << 19
#: range partitions for each partition of the input
SPREAD = 4
#: texts, and of their suffixes rows, that the splitters are drawn from
SAMPLE_TEXTS, SAMPLE_ROWS = 2_000, 1 << 16
_PLACE = np.uint64((1 << 21) - 1)
_LAST_ID = (1 << 63) - 1

_rng = np.random.default_rng(20260712)
_TABLES = _rng.integers(1, 1 << 63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: at: first window << 16 | distance to the suffix << 8 | windows
_ROWS = "bucket int, h1 long, h2 long, doc long, th long, at long, part long, bytes binary"
_NAMES = ["bucket", "h1", "h2", "doc", "th", "at", "part", "bytes"]
_BY = ["h1", "h2", "doc", "place", "part"]
MARK, FINER, EDGE, TAIL = 0, 1, 2, 3


class _Hashes:
    """Hashes of any range of a buffer, from prefix sums."""

    def __init__(self, buf: np.ndarray):
        up, self.down = _Powers.of(len(buf) + 1)
        self.sums = np.zeros((2, len(buf) + 1), dtype=np.uint64)
        for table, s in zip(_TABLES, self.sums, strict=True):
            np.cumsum(table[buf] * up[:-1], out=s[1:])

    def of(self, k: int, start, end) -> np.ndarray:
        return mix((self.sums[k][end] - self.sums[k][start]) * self.down[start])


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values."""
    step = 1
    while 2 * step <= width:
        values, step = np.minimum(values[:-step], values[step:]), 2 * step
    return np.minimum(values[:len(values) - (width - step)], values[width - step:])


def suffixes(buf: np.ndarray, ends: np.ndarray):
    """(text, first window, chosen place, windows, h1, h2) of every suffix of a
    buffer of texts, each of LENGTH bytes at least, that end at ``ends``; all
    windows of a suffix follow one another."""
    hashes = _Hashes(buf)
    starts = np.arange(len(buf) - TOKEN + 1)
    token = hashes.of(0, starts, starts + TOKEN)
    chosen = (_least((token & ~_PLACE) | starts.astype(np.uint64), LENGTH - TOKEN + 1) & _PLACE).astype(np.int64)
    text = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))[:len(chosen)]
    window = np.flatnonzero(np.arange(len(chosen)) + LENGTH <= ends[text])
    place, text = chosen[window], text[window]
    new = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (text[1:] != text[:-1])]))
    first, n, place, text = window[new], np.diff(np.append(new, len(window))), place[new], text[new]
    h2 = _context(hashes, first, place - first, n)
    return text, first, place, n, token[place].view(np.int64), h2


def _context(hashes: _Hashes, first: np.ndarray, to_place: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Hash of the bytes of n windows and of their distance to the suffix."""
    h = hashes.of(1, first, first + n - 1 + LENGTH)
    return mix(h + (to_place << 8 | n).astype(np.uint64)).view(np.int64)


def _parts(texts: list[bytes], limit: int):
    """Lists of (index, offset, bytes) of about ``limit`` bytes. Parts of a long
    text overlap, so that every window lies in one part; a suffix whose windows
    a part's end divides becomes two, which differ from a whole one and are
    compared finer."""
    held, size = [], 0
    for i, t in enumerate(texts):
        if len(t) < LENGTH:
            continue
        for o in range(0, max(1, len(t) - LENGTH + 1), limit):
            piece = t[o:o + limit + LENGTH - 1]
            held.append((i, o, piece))
            size += len(piece)
            if size >= limit:
                yield held
                held, size = [], 0
    if held:
        yield held


def _pack(first: np.ndarray, to_place: np.ndarray, n: np.ndarray) -> np.ndarray:
    return first.astype(np.int64) << 16 | to_place << 8 | n


def _bucket(splitters: list[np.ndarray], columns: list[np.ndarray]) -> np.ndarray:
    """How many splitters are not above each row, column by column."""
    low = np.searchsorted(splitters[0], columns[0], side="left")
    high = np.searchsorted(splitters[0], columns[0], side="right")
    if len(splitters) == 1:
        return high
    tied, out = np.flatnonzero(high > low), low.copy()
    for k in np.unique(low[tied]).tolist():
        rows = tied[low[tied] == k]
        run = slice(k, high[rows[0]])
        out[rows] = k + _bucket([x[run] for x in splitters[1:]], [c[rows] for c in columns[1:]])
    return out


def _batch(splitters, h1, h2, doc, th, at, part: int | np.ndarray, raw=None) -> pa.RecordBatch:
    part = np.full(len(at), part, np.int64) if isinstance(part, int) else part
    bucket = np.zeros(len(at), np.int32) if splitters is None else _bucket(splitters, [h1, h2, doc, at >> 16, part])
    cols = [pa.array(bucket.astype(np.int32)), *(pa.array(x) for x in (h1, h2, doc, th, at, part)),
            pa.nulls(len(at), pa.binary()) if raw is None else pa.array(raw, pa.binary())]
    return pa.RecordBatch.from_arrays(cols, names=_NAMES)


def _splitters(sample: DataFrame, buckets: int) -> list[np.ndarray]:
    """Rows that cut a bounded sample into ``buckets`` runs of equal length."""
    t = sample.select("h1", "h2", "doc", F.shiftright("at", 16).alias("place"), "part").orderBy(F.rand(11)).limit(
        SAMPLE_ROWS).toArrow()
    columns = [t.column(c).to_numpy() for c in _BY]
    order = np.lexsort(columns[::-1])
    cuts = order[np.unique(np.arange(1, buckets) * len(order) // buckets)] if len(order) else order
    return [c[cuts] for c in columns]


def _first_rows(docs: DataFrame, splitters: list[np.ndarray] | None = None) -> DataFrame:
    def run(batches):
        part = TaskContext.get().partitionId()
        for b in batches:
            doc, th = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)
            for held in _parts([t or b"" for t in utf8(b.column(2))], PART):
                which, offset = np.array([i for i, _, _ in held]), np.array([o for _, o, _ in held])
                ends = np.cumsum([len(t) for _, _, t in held])
                buf = np.frombuffer(b"".join(t for _, _, t in held), np.uint8)
                text, first, place, n, h1, h2 = suffixes(buf, ends)
                begin = offset[text] - np.concatenate([[0], ends])[text]
                row = which[text]
                yield _batch(splitters, h1, h2, doc[row], th[row], _pack(first + begin, place - first, n), part)
    return docs.select("doc", "th", "text").mapInArrow(run, _ROWS)


def _cut(buf: np.ndarray, begin: np.ndarray, at: np.ndarray, block: int):
    """Suffixes of ``buf`` (which hold their windows' bytes from ``begin``) cut
    into blocks of ``block`` windows by the distance to the chosen place:
    (suffix, first window, distance, windows, h1, h2, first byte, last)."""
    n, to_place = at & 0xFF, at >> 8 & 0xFF
    owner = np.repeat(np.arange(len(at)), n)
    k = np.arange(len(owner)) - (np.cumsum(n) - n)[owner]
    number = (to_place[owner] - k) // block  # of the block; equal windows have equal distances
    new = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (number[1:] != number[:-1])])[:len(owner)])
    owner, k, size, number = owner[new], k[new], np.diff(np.append(new, len(k))), number[new]
    distance, start = to_place[owner] - k, begin[owner] + k
    hashes = _Hashes(buf)
    if block > 1:
        place = start + distance
        h1 = mix(hashes.of(0, place, place + TOKEN) + number.astype(np.uint64)).view(np.int64)
        h2 = _context(hashes, start, distance, size)
    else:
        h1, h2 = (hashes.of(t, start, start + LENGTH).view(np.int64) for t in (0, 1))
    return owner, (at[owner] >> 16) + k, distance, size, h1, h2, start


def _finer_rows(rows: DataFrame, splitters: list[np.ndarray] | None = None) -> DataFrame:
    """Blocks of the suffixes listed (``cuts``) beside each text."""
    def run(batches):
        part = TaskContext.get().partitionId()

        def cut(held):
            raw = b"".join(x[2] for x in held)
            shift = np.cumsum([0, *(len(x[2]) for x in held[:-1])])
            at = np.concatenate([x[3] for x in held])
            of = np.repeat(np.arange(len(held)), [len(x[3]) for x in held])
            begin = (at >> 16) - np.array([x[4] for x in held])[of] + shift[of]
            owner, p, o, n, h1, h2, start = _cut(np.frombuffer(raw, np.uint8), begin, at, BLOCK)
            ctx = [raw[x:y] for x, y in zip(start.tolist(), (start + n - 1 + LENGTH).tolist(), strict=True)]
            doc, th = (np.array([x[k] for x in held], dtype=np.int64)[of[owner]] for k in (0, 1))
            return _batch(splitters, h1, h2, doc, th, _pack(p, o, n), part, ctx)

        for b in batches:
            held, size = [], 0
            for d, th, t, cuts in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), utf8(b.column(2)),
                                      b.column(3), strict=True):
                at = np.sort(cuts.values.to_numpy())
                first = at >> 16
                group = np.concatenate([[0], np.flatnonzero(np.diff(first // PART)) + 1, [len(at)]])
                for i, j in zip(group, group[1:], strict=False):  # a long text in parts
                    lo, hi = int(first[i]), int((first[i:j] + (at[i:j] & 0xFF)).max()) - 1 + LENGTH
                    held.append((d, th, t[lo:hi], at[i:j], lo))
                    size += hi - lo
                    if size >= PART:
                        yield cut(held)
                        held, size = [], 0
            if held:
                yield cut(held)

    return rows.select("doc", "th", "text", "cuts").mapInArrow(run, _ROWS)


def _last_rows(rows: DataFrame, splitters: list[np.ndarray] | None = None) -> DataFrame:
    """Single windows of blocks, from the bytes these carry."""
    def run(batches):
        for b in batches:
            raw = b.column("bytes").to_pylist()
            ends = np.cumsum([len(x) for x in raw])
            at = b.column("at").to_numpy()
            if not len(at):
                continue
            begin = np.concatenate([[0], ends[:-1]]).astype(np.int64)
            owner, p, o, n, h1, h2, _ = _cut(np.frombuffer(b"".join(raw), np.uint8), begin, at, 1)
            doc, th, part = (b.column(c).to_numpy()[owner] for c in ("doc", "th", "part"))
            yield _batch(splitters, h1, h2, doc, th, _pack(p, o, n), part)
    return rows.select("doc", "th", "at", "part", "bytes").mapInArrow(run, _ROWS)


def multikey_order(columns: list[np.ndarray]) -> np.ndarray:
    """Multikey quicksort: rows by the first column, then runs of equal rows
    by the next, and so on."""
    order = np.argsort(columns[0])
    new = np.concatenate([[True], np.diff(columns[0][order]) != 0])[:len(order)]
    for c in columns[1:]:
        tied = np.flatnonzero(~(new & np.append(new[1:], True)))
        rows = order[tied]
        run = np.cumsum(new)[tied]
        rows = rows[np.lexsort((c[rows], run))]
        order[tied] = rows
        new[tied[1:]] |= (np.diff(c[rows]) != 0) & (np.diff(tied) == 1)
    return order


def _compare(rows: DataFrame, buckets: int, last: bool, name: str) -> DataFrame:
    """(doc, th, at, part, kind, bytes) of a written table: MARK for suffixes that an
    equal one precedes, FINER for the earliest of each kind where the leading
    token has another kind too (none if ``last``)."""
    schema = "h1 long, h2 long, doc long, th long, at long, part long, kind int, bytes binary"

    def run(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        t = pa.Table.from_batches(held)
        h1, h2, doc, th, at, part = (t.column(c).to_numpy() for c in ("h1", "h2", "doc", "th", "at", "part"))
        order = multikey_order([h1, h2, doc, at >> 16])
        h1, h2, doc, place = h1[order], h2[order], doc[order], at[order] >> 16
        new_token = np.concatenate([[True], h1[1:] != h1[:-1]])
        new = new_token | np.concatenate([[True], h2[1:] != h2[:-1]])
        run_of = np.cumsum(new) - 1
        head = np.flatnonzero(new)[run_of]  # the earliest of each run
        later = (doc != doc[head]) | (place != place[head])
        kind = np.full(len(h1), -1)
        kind[later] = MARK
        if not last:
            token = np.cumsum(new_token) - 1
            several = np.bincount(token, new) > 1
            several[[0, -1]] = True  # the buckets beside may hold others
            kind[~later & several[token]] = FINER
        kind[(run_of == 0) & ~later] = EDGE  # whether earlier ones exist the buckets before know
        out = np.flatnonzero(kind >= 0)
        kinds = kind[out]
        if run_of[-1] > 0:  # the earliest of the last run, for the buckets after
            out, kinds = np.append(out, head[-1]), np.append(kinds, TAIL)
        t = t.take(pa.array(order[out])).append_column("kind", pa.array(kinds, pa.int32()))
        t = t.select(["h1", "h2", "doc", "th", "at", "part", "kind", "bytes"])
        yield from t.to_batches(1 << 14)

    told = stage(rows.repartitionById(buckets, "bucket").drop("bucket").mapInArrow(run, schema), name,
                 {"compression": "zstd"})
    ends = told.where(F.col("kind").isin(EDGE, TAIL))
    place = F.struct("doc", F.shiftright("at", 16).alias("p"))
    # two runs a bucket at most
    first = ends.groupBy("h1", "h2").agg(F.min(place).alias("first"))
    edge = ends.where(F.col("kind") == EDGE).join(F.broadcast(first), ["h1", "h2"]).select(
        "doc", "th", "at", "part",
        F.when(place == F.col("first"), F.lit(-1 if last else FINER)).otherwise(F.lit(MARK)).alias("kind"), "bytes")
    return told.where(F.col("kind").isin(MARK, FINER)).drop("h1", "h2").unionByName(
        edge.where("kind >= 0"))


def _listed(rows: DataFrame, kind: int, name: str) -> DataFrame:
    """(doc, th, name): the distinct suffixes of one kind of each text."""
    return rows.where(F.col("kind") == kind).groupBy("doc", "th").agg(F.collect_set("at").alias(name))


def repeated(docs: DataFrame) -> DataFrame:
    """(doc, th, marks) of prepared rows (doc, th, text): the windows to remove
    of each text that has any, as first window << 16 | ... | windows."""
    spark = docs.sparkSession
    ship(spark)
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), SPREAD * docs.rdd.getNumPartitions())
    some = docs.where(F.rand(5) < SAMPLE_TEXTS / max(1, docs.count()))  # steers the splitters, never the result
    coarse = _compare(_first_rows(docs, _splitters(_first_rows(some), buckets)), buckets, False, "suffixes")
    listed = stage(_listed(coarse, FINER, "cuts"), "suffix-cuts")
    finer = _splitters(_finer_rows(some.join(listed, ["doc", "th"])), buckets)
    blocks = _compare(_finer_rows(docs.join(listed, ["doc", "th"]), finer), buckets, False, "suffix-blocks")
    rest = blocks.where(F.col("kind") == FINER)
    few = rest.where(F.rand(5) < SAMPLE_ROWS / max(1, rest.count()))
    single = _compare(_last_rows(rest, _splitters(_last_rows(few), buckets)), buckets, True, "suffix-windows")
    marks = [x.where(F.col("kind") == MARK).select("doc", "th", "at", "kind") for x in (coarse, blocks, single)]
    return _listed(marks[0].unionByName(marks[1]).unionByName(marks[2]), MARK, "marks")


def _prepared(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text: Column = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST_ID)).alias("doc"),
                       F.xxhash64(F.col(id_col).isNull(), text).alias("th"),
                       F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, kept binary, n_bytes, n_removed, n_spans, spans array of
    (start, end)) of every document; ``kept`` may cut a character in two, as
    strings are judged by bytes."""
    prepared = _prepared(docs, id_col, text_col)
    rows = prepared.join(repeated(prepared), ["doc", "th"], "left").select("doc_id", "text", "marks")
    schema = ("doc_id long, kept binary, n_bytes long, n_removed long, n_spans long, "
              "spans array<struct<start: long, end: long>>")
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def run(batches):
        for b in batches:
            kept, numbers, spans = [], [], []
            for t, marks in zip(utf8(b.column(1)), b.column(2), strict=True):
                found = []
                if marks.is_valid:
                    at = marks.values.to_numpy()
                    step = np.zeros(len(t) + 1, dtype=np.int32)
                    np.add.at(step, at >> 16, 1)
                    np.add.at(step, (at >> 16) + (at & 0xFF) - 1 + LENGTH, -1)
                    gone = np.cumsum(step[:-1]) > 0
                    turn = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0)).tolist()
                    found = list(zip(turn[::2], turn[1::2], strict=True))
                    whole, t = len(t), np.frombuffer(t, np.uint8)[~gone].tobytes()
                else:
                    whole = len(t)
                kept.append(t)
                numbers.append((whole, whole - len(t), len(found)))
                spans.append([{"start": i, "end": j} for i, j in found])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(kept, pa.binary()), *(pa.array([x[k] for x in numbers], pa.int64()) for k in range(3)),
                 pa.array(spans, pa.list_(span))], names=["doc_id", "kept", "n_bytes", "n_removed", "n_spans", "spans"])
    return rows.mapInArrow(run, schema)


def digest(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
