"""Alignment of two tokenizers' ids over the same texts.

Each text is tokenised whole by both tokenizers (a leading space included).
Where a space-marked token of each starts at one byte, the tokens before them
end there too: such verified shared ends cut a document into windows of about
a word. The alignment of a window (its groups between shared ends and its
links, the pairs of tokens that end together) depends on its two tuples of ids
alone and is remembered by them, in two generations of bounded size.

Link counts: of two linked tokens one's bytes end with the other's, so the
pairs that can ever be linked are a property of the two vocabularies
(``pair_bound``, some 300,000 for the public ones). Every task sums its pairs
before the shuffle, and the table of counts may be sent to all tasks while its
bound stays below ``BROADCAST_PAIRS``; beyond it links meet their counts in a
join. Links are kept in the written table, so no text is tokenised twice.

Edge cases: a NULL or empty text, or one that either tokenizer does not give
back byte by byte, has no tokens and zeros; repeated rows and ids count each
time; special-token strings are plain text; no documents give no rows; other
columns are ignored, whatever their names. A document is one row: its ids are
in memory at a time, about ten bytes a byte of text.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_groups, ship, stage
from .tokens import BothEncoder, Encoder, PieceEncoder, encoder, no_cycles, piece_encoder
from .words import _Powers, mix

#: a table of more pair counts than this is joined, not broadcast
BROADCAST_PAIRS = 1 << 22
#: bound of each of the memo's two generations
MEMO_BYTES = 32 << 20
#: bytes of text aligned at a time
GROUP_BYTES = 3 << 19


def pair_bound(a: list[bytes], b: list[bytes]) -> int:
    """How many pairs of entries exist of which one ends with the other."""
    def ends(of: list[bytes], table: dict[bytes, int], skip: int) -> int:
        return sum(table.get(x[k:], 0) for x in of for k in range(skip, len(x)))

    def tally(of: list[bytes]) -> dict[bytes, int]:
        t: dict[bytes, int] = {}
        for x in of:
            t[x] = t.get(x, 0) + 1
        return t
    return ends(a, tally(b), 0) + ends(b, tally(a), 1)


def code_kind(size_a: int, size_b: int) -> str:
    """Type of a pair's code, id of a times ``size_b`` plus id of b."""
    return "<i4" if size_a * size_b < 1 << 31 else "<i8"


def _shared(size: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which of the places 0 to ``size`` are in both."""
    both = np.zeros(size + 1, dtype=np.int8)
    both[x] = 1
    both[y] |= 2
    return both == 3


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... of every range, ``size`` of each."""
    return np.arange(int(size.sum())) + np.repeat(start - np.cumsum(size) + size, size)


class Aligner:
    """Aligns ids of ``a`` (byte-level) and ``b`` (sentencepiece), many
    documents at a time."""

    def __init__(self, a: Encoder, b: PieceEncoder, memo_bytes: int = MEMO_BYTES):
        self.encode = BothEncoder(a, b)
        self.bytes_a, self.bytes_b = a.entries(), b.entries()
        self.len_a, self.len_b = (np.array([len(x) for x in t], dtype=np.int64) for t in (self.bytes_a, self.bytes_b))
        self.flat_a, self.flat_b = (np.frombuffer(b"".join(t), np.uint8) for t in (self.bytes_a, self.bytes_b))
        rng = np.random.default_rng(20261204)
        self.marks_a, self.marks_b = (rng.integers(1, 1 << 63, (2, len(t)), dtype=np.uint64)
                                      for t in (self.bytes_a, self.bytes_b))
        self.space_a, self.space_b = (np.array([x[:1] == b" " for x in t]) for t in (self.bytes_a, self.bytes_b))
        self.width = len(self.bytes_b)
        most = max(len(self.bytes_a), self.width)
        text = np.array([str(i).encode() for i in range(most)])
        self.digits = text.view(np.uint8).reshape(most, -1)
        self.n_digits = (self.digits != 0).sum(axis=1)
        self.kind = code_kind(len(self.bytes_a), self.width)
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.memo_bytes, self.size = memo_bytes, 0

    def _groups(self, ids_a: np.ndarray, ids_b: np.ndarray, window_ends: np.ndarray) -> list[bytes]:
        """Texts of the groups of windows laid end to end."""
        end_a, end_b = np.cumsum(self.len_a[ids_a]), np.cumsum(self.len_b[ids_b])
        both = _shared(int(window_ends[-1]), end_a, end_b)
        shared = np.cumsum(both)
        group_a, group_b = shared[end_a - 1], shared[end_b - 1]
        last_a, last_b = both[end_a], both[end_b]
        # every group's ids of a, then its ids of b, each with the mark after it
        n_a, n_b = (np.bincount(g, minlength=shared[-1]) for g in (group_a, group_b))
        at_a = np.arange(len(ids_a)) + (np.cumsum(n_b) - n_b)[group_a]
        at_b = np.arange(len(ids_b)) + np.cumsum(n_a)[group_b]
        ids = np.empty(len(ids_a) + len(ids_b), dtype=np.int64)
        mark = np.full(len(ids), ord(","), dtype=np.uint8)
        ids[at_a], ids[at_b] = ids_a, ids_b
        mark[at_a[last_a]], mark[at_b[last_b]] = ord("|"), ord(";")
        size = self.n_digits[ids]
        chars = np.zeros((len(ids), self.digits.shape[1] + 1), dtype=np.uint8)
        chars[:, :-1] = self.digits[ids]
        chars[np.arange(len(ids)), size] = mark
        flat = chars[chars != 0].tobytes()
        ends = np.cumsum(size + 1)[at_b[last_b][shared[window_ends] - 1]].tolist()
        return [flat[i:j - 1] for i, j in zip([0, *ends[:-1]], ends, strict=True)]

    def _remembered(self, ids_a, cut_a, ids_b, cut_b, of: np.ndarray) -> list[bytes]:
        """Texts of the groups of the windows ``of``. A window's key is its
        tuple of ids of a and that of b, packed."""
        n_a, n_b = cut_a[of + 1] - cut_a[of], cut_b[of + 1] - cut_b[of]
        size = n_a + n_b + 1
        begin = np.cumsum(size) - size
        packed = np.full(int(size.sum()), 0xFFFFFFFF, dtype="<u4")  # no id: it parts the two tuples
        packed[_ranges(begin, n_a)] = ids_a[_ranges(cut_a[of], n_a)]
        packed[_ranges(begin + n_a + 1, n_b)] = ids_b[_ranges(cut_b[of], n_b)]
        raw, ends = packed.tobytes(), (4 * (begin + size)).tolist()
        keys = [raw[i:j] for i, j in zip([0, *ends[:-1]], ends, strict=True)]
        found = list(map(self.young.get, keys))
        missing = [k for k, x in enumerate(found) if x is None]
        if missing:
            wanted = [keys[k] for k in missing]
            texts = list(map(self.old.get, wanted))
            new = [k for k, x in enumerate(texts) if x is None]
            if new:
                w = of[np.array(missing)[new]]
                x, y = cut_a[w + 1] - cut_a[w], cut_b[w + 1] - cut_b[w]
                x_ids, y_ids = ids_a[_ranges(cut_a[w], x)], ids_b[_ranges(cut_b[w], y)]
                for k, text in zip(new, self._groups(x_ids, y_ids, np.cumsum(self.len_a[x_ids])[np.cumsum(x) - 1]), strict=True):
                    texts[k] = text
            if self.size > self.memo_bytes:
                self.old, self.young, self.size = self.young, {}, 0
            self.young.update(zip(wanted, texts, strict=True))
            self.size += 180 * len(wanted) + sum(map(len, wanted)) + sum(map(len, texts))
            for k, x in zip(missing, texts, strict=True):
                found[k] = x
        return found

    def documents(self, texts: list[bytes], raw_a: list[bytes], raw_b: list[bytes]):
        """For each text (with its leading space): (tokens of a, of b, groups
        as text, pair codes), or None where the bytes of either tokenizer are
        not the text's."""
        out: list[tuple | None] = [None] * len(texts)
        good = self._faithful(texts, ((raw_a, self.len_a, self.flat_a), (raw_b, self.len_b, self.flat_b)))
        if not good:
            return out
        ids_a, ids_b = (np.frombuffer(b"".join([raw[k] for k in good]), "<u4") for raw in (raw_a, raw_b))
        size_a, size_b = self.len_a[ids_a], self.len_b[ids_b]
        end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)
        begin_a, begin_b = end_a - size_a, end_b - size_b
        first = np.cumsum([0, *(len(texts[k]) for k in good)])
        # verified shared ends before space-marked tokens, and the texts' begins
        begins = _shared(int(first[-1]), begin_a[self.space_a[ids_a]], begin_b[self.space_b[ids_b]])
        begins[first[:-1]] = True
        cut_a, cut_b = np.flatnonzero(begins[begin_a]), np.flatnonzero(begins[begin_b])
        windows = np.searchsorted(begin_a[cut_a], first).tolist()
        cut_a, cut_b = np.append(cut_a, len(ids_a)), np.append(cut_b, len(ids_b))
        kinds, which = self._distinct(((ids_a, cut_a, self.marks_a), (ids_b, cut_b, self.marks_b)))
        text = list(map(self._remembered(ids_a, cut_a, ids_b, cut_b, kinds).__getitem__, which))
        ends = _shared(int(first[-1]), end_a, end_b)
        last_a, last_b = ends[end_a], ends[end_b]
        codes = (ids_a[last_a].astype(np.int64) * self.width + ids_b[last_b]).astype(self.kind)
        links = np.searchsorted(end_a[last_a], first, side="right").tolist()
        for n, k in enumerate(good):
            out[k] = (len(raw_a[k]) // 4, len(raw_b[k]) // 4, b";".join(text[windows[n]:windows[n + 1]]),
                      codes[links[n]:links[n + 1]].tobytes())
        return out

    @staticmethod
    def _faithful(texts: list[bytes], tokenised) -> list[int]:
        """The texts that all tokenizers give back byte by byte."""
        want = np.array([len(t) for t in texts])
        good = want > 0
        for raw, length, flat in tokenised:
            ids = np.frombuffer(b"".join(raw), "<u4")
            size = length[ids]
            ends = np.concatenate([[0], np.cumsum(size)])
            got = np.diff(ends[np.cumsum([0, *(len(x) // 4 for x in raw)])])
            good &= got == want
            if (got == want).all():  # bytes of all texts at once
                begin = np.cumsum(length) - length
                at = np.arange(ends[-1]) + np.repeat(begin[ids] - ends[:-1], size)
                same = flat[at] == np.frombuffer(b"".join(texts), np.uint8)
                wrong = np.searchsorted(np.cumsum(want), np.flatnonzero(~same), side="right")
                good[wrong] = False
            else:
                table = np.cumsum(length) - length
                for k in np.flatnonzero(good).tolist():
                    x = np.frombuffer(raw[k], "<u4")
                    spelled = b"".join([flat[i:j].tobytes() for i, j in zip(table[x], table[x] + length[x], strict=True)])
                    good[k] = spelled == texts[k]
        return np.flatnonzero(good).tolist()

    @staticmethod
    def _distinct(sides) -> tuple[np.ndarray, list[int]]:
        """One window of each kind, and every window's place among these.
        Windows with equal 128-bit hashes of their ids are of one kind."""
        hashes = []
        for k in range(2):
            h = np.uint64(k)
            for ids, cut, marks in sides:
                up, down = _Powers.of(len(ids) + 1)
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(marks[k][ids] * up[:-1])])
                h = mix(h + (sums[cut[1:]] - sums[cut[:-1]]) * down[cut[:-1]])
            hashes.append(h)
        order = np.argsort(hashes[0])
        new, other = (np.concatenate([[True], np.diff(h[order]) != 0]) for h in hashes)
        if (other & ~new).any():  # equal in the first hash alone
            order = np.lexsort(hashes)
            new = np.logical_or(*(np.concatenate([[True], np.diff(h[order]) != 0]) for h in hashes))
        which = np.empty(len(order), dtype=np.int64)
        which[order] = np.cumsum(new) - 1
        return order[new], which.tolist()


_aligners: dict[tuple, Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """The process's aligner of two tokenizer files."""
    if (path_a, path_b) not in _aligners:
        _aligners[path_a, path_b] = Aligner(encoder(path_a, special_as_text=True), piece_encoder(path_b))
    return _aligners[path_a, path_b]


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
          keep_groups: bool = False) -> DataFrame:
    """Written table (row, doc_id, n_a, n_b, n_groups, n_links, groups_sha256,
    links) with one row a document; ``links`` holds a code (``code_kind``) a link. ``keep_groups`` adds the
    groups as text."""
    ship(docs.sparkSession)
    schema = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
              "links binary" + (", groups string" if keep_groups else ""))
    names = [f.split()[0] for f in schema.split(", ")]

    def aligned(one: Aligner, ids, texts: list, row: int) -> pa.RecordBatch:
        spaced = [" " + t if t else "" for t in texts]
        out = [x or (0, 0, b"", b"") for x in one.documents([t.encode() for t in spaced], *one.encode(spaced))]
        links = pa.array([len(x[3]) // int(one.kind[2]) for x in out], pa.int64())
        cols = [pa.array(range(row, row + len(out)), pa.int64()), ids, *(pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)),
                links, links, pa.array([hashlib.sha256(x[2]).hexdigest() if x[2] else "" for x in out], pa.string()),
                pa.array([x[3] for x in out], pa.binary())]
        if keep_groups:
            cols.append(pa.array([x[2].decode() for x in out], pa.string()))
        return pa.RecordBatch.from_arrays(cols, names=names)

    def run(batches):
        one, row = aligner(path_a, path_b), TaskContext.get().partitionId() << 32
        with no_cycles():
            for b in batches:
                ids, texts = b.column(0), b.column(1).to_pylist()
                for i, j in doc_groups(ids, texts, GROUP_BYTES):
                    yield aligned(one, ids.slice(i, j - i), texts[i:j], row)
                    row += j - i

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return stage(rows.mapInArrow(run, schema), "aligned", {"compression": "zstd"})


def pair_counts(aligned: DataFrame, width: int, kind: str) -> DataFrame:
    """Written table (code, b, n, best): links of each pair over all documents
    and whether that is the highest count of its b id."""
    def run(batches):
        codes, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for b in batches:
            new, n = np.unique(np.frombuffer(b"".join(b.column(0).to_pylist()), kind), return_counts=True)
            codes, place = np.unique(np.concatenate([codes, new]), return_inverse=True)
            counts = np.bincount(place, np.concatenate([counts, n]), len(codes)).astype(np.int64)
        yield pa.RecordBatch.from_pydict({"code": codes, "n": counts})

    n = stage(aligned.select("links").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")),
              "pairs").withColumn("b", F.col("code") % width)
    most = n.groupBy("b").agg(F.max("n").alias("most"))
    return stage(n.join(most, "b").select("code", "b", "n", (F.col("n") == F.col("most")).alias("best")), "pair-counts")


def score_links(aligned: DataFrame, pairs: DataFrame, bound: int, kind: str) -> DataFrame:
    """``aligned`` with n_best and count_sum in place of ``links``. ``bound``
    is the proven bound on the rows of ``pairs``."""
    spark = aligned.sparkSession
    keep = [c for c in aligned.columns if c != "links"]
    if bound > BROADCAST_PAIRS:
        return _score_by_join(aligned, pairs, keep, kind)
    table = pairs.select("code", "n", "best").toArrow().sort_by("code")
    sent = spark.sparkContext.broadcast((table["code"].to_numpy(), table["n"].to_numpy(),
                                         table["best"].to_numpy(zero_copy_only=False).astype(np.int64)))

    def run(batches):
        code, n, best = sent.value
        for b in batches:
            links = b.column("links").to_pylist()
            some, place = np.unique(np.frombuffer(b"".join(links), kind), return_inverse=True)
            at = np.searchsorted(code, some)[place]
            ends = np.cumsum([len(x) // int(kind[2]) for x in links])
            cols = [b.column(c) for c in keep]
            for value in (best, n):
                sums = np.concatenate([[0], np.cumsum(value[at])])[np.concatenate([[0], ends])]
                cols.append(pa.array(np.diff(sums), pa.int64()))
            yield pa.RecordBatch.from_arrays(cols, names=[*keep, "n_best", "count_sum"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in aligned.schema if f.name in keep)
    return aligned.select(*keep, "links").mapInArrow(run, f"{schema}, n_best long, count_sum long")


def _score_by_join(aligned: DataFrame, pairs: DataFrame, keep: list[str], kind: str) -> DataFrame:
    def run(batches):
        for b in batches:
            for row, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                code, n = np.unique(np.frombuffer(x, kind), return_counts=True)
                yield pa.RecordBatch.from_pydict({"row": np.full(len(code), row), "code": code.astype(np.int64), "times": n})
    links = stage(aligned.select("row", "links").mapInArrow(run, "row long, code long, times long"), "links")
    times = F.col("times")
    sums = links.join(pairs, "code").groupBy("row").agg(
        F.sum(F.when(F.col("best"), times).otherwise(0)).alias("n_best"), F.sum(F.col("n") * times).alias("count_sum"))
    zero = F.lit(0).cast("long")
    return aligned.select(*keep).join(sums, "row", "left").select(
        *keep, F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"))


def digest(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    aligned = align(docs, path_a, path_b)
    a, b = Encoder(path_a, special_as_text=True).entries(), PieceEncoder(path_b).entries()
    kind = code_kind(len(a), len(b))
    scored = score_links(aligned, pair_counts(aligned, len(b), kind), pair_bound(a, b), kind)
    return scored.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
