"""Phrase collocations from FM-indexes over word ids.

Texts are lower-cased (A-Z), split into pieces at punctuation and line ends
and into words at blanks. Every task cuts its documents into shards of about
``SHARD_WORDS`` words and writes each shard's bidirectional FM-index: the BWT
of the word ids and that of the reversed ids, the alphabet being (lang, word).
Suffixes are sorted by their first ``DEPTH`` words, which is all that intervals
of phrases up to that length need.

Phrases grow by one word a level: left by the BWT, then right by the reverse
BWT, then left, both intervals kept in step. A level extends only intervals
whose phrase is frequent in all shards together, since a phrase is at most as
frequent as its parts. A shard sends its phrases as 96-bit hashes with counts,
sorted and cut by hash ranges into one compact row a range; a range's task sums
the counts of all shards and answers every shard with one bit a phrase. Shards
find their intervals again from the index and these bits, so no interval is
ever moved. At last each frequent phrase is spelled by one of the shards that
hold it, which its hash chooses. Phrases are told apart by their 96-bit hashes.
An index is written and moved in parts of about ``PART_BYTES``, read ``_ROWS``
at a time, so what the JVM holds of it does not grow with the shards.

Edge cases: a NULL or empty text has no words, a NULL lang counts as ``und``;
repeated rows count each time; tied scores rank by count, then by the bytes of
the phrase; no documents, or no frequent phrase, give no rows; other columns
are ignored. A text of any length is read in slices, but a shard holds at least
one whole piece between two marks.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import release, ship, stage, utf8

DEPTH = 4
SHARD_WORDS = 1 << 20
SLICE_BYTES = 1 << 22
#: a shard's index is moved in rows of about so many bytes, that the JVM holds few of at once
PART_BYTES = 1 << 17
_ROWS = 32
_TOKEN = re.compile(rb"[^\x20\x09.,;:!?\x0A-\x0D]+|[.,;:!?\x0A-\x0D]+")
_MARK = re.compile(rb"[.,;:!?\x0A-\x0D]")
_MARKS = frozenset(b".,;:!?\n\x0b\x0c\r")
_POWERS = np.array([pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(DEPTH + 1)], dtype=np.uint64)

_INDEX = ("shard long, part int, langs array<string>, totals array<long>, lang binary, words binary, counts binary, "
          "bwt binary, rbwt binary")
_WRITE = {"compression": "zstd", "parquet.block.size": str(16 << 20), "parquet.block.size.row.check.min": str(_ROWS),
          "parquet.page.row.count.limit": "8", "parquet.enable.dictionary": "false"}
_COUNTS = "range int, shard long, h binary, g binary, n binary"
_BITS = "shard long, level int, range int, bits binary, first binary, total binary"


class _Alphabet:
    """Ids 1, 2, ... of (lang, word) in order of appearance; 0 is a mark."""

    def __init__(self):
        self.words: list[bytes] = []
        self.lang: list[int] = []
        self.langs: dict[str, int] = {}
        self.tables: list[dict[bytes, int]] = []

    def of(self, lang: str) -> dict[bytes, int]:
        if lang not in self.langs:
            k = self.langs[lang] = len(self.tables)

            class Ids(dict):
                def __missing__(ids, word: bytes) -> int:  # noqa: N805
                    if word[0] in _MARKS:
                        return 0
                    self.words.append(word)
                    self.lang.append(k)
                    ids[word] = len(self.words)
                    return len(self.words)
            self.tables.append(Ids())
        return self.tables[self.langs[lang]]


def _slices(text: bytes):
    """The text in parts of about SLICE_BYTES that end at a mark."""
    at = 0
    while len(text) - at > SLICE_BYTES:
        cut = _MARK.search(text, at + SLICE_BYTES)
        if cut is None:
            break
        yield text[at:cut.end()]
        at = cut.end()
    yield text[at:]


def _sorted(key: np.ndarray, most: int) -> np.ndarray:
    """Order of the keys (at most ``most``), ties by place."""
    bits = len(key).bit_length()
    if most.bit_length() + bits > 64:
        return np.argsort(key, kind="stable")
    packed = np.sort(key.astype(np.uint64) << np.uint64(bits) | np.arange(len(key), dtype=np.uint64))
    return (packed & np.uint64((1 << bits) - 1)).astype(np.int64)


def suffix_order(ids: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` symbols at least, by
    doubling the length that ranks stand for."""
    rank, known, n = ids.astype(np.int64), 1, len(ids)
    order = _sorted(rank, int(rank.max(initial=0))) if depth == 1 else None
    while known < depth:
        after = np.zeros(n, dtype=np.int64)
        after[:n - known] = rank[known:]
        base = int(rank.max(initial=0)) + 1
        key = rank * base + after
        order = _sorted(key, base * base)
        key = key[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]]))
        known *= 2
    return order


def bwt(ids: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Symbol before each suffix, in suffix order (the last one before the first)."""
    return ids[suffix_order(ids, depth) - 1]


def _runs(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows of all intervals in order, the interval each row is of)"""
    owner = np.repeat(np.arange(len(start)), size)
    before = np.cumsum(size) - size
    return np.arange(len(owner)) - before[owner] + start[owner], owner


class PhraseIndex:
    """One shard's index. An interval is (at, rat, n): the first row in suffix
    order, the first row in the order of reversed prefixes, and the count."""

    def __init__(self, counts: np.ndarray, forward: np.ndarray | None = None, reverse: np.ndarray | None = None):
        self.counts = counts
        self.first = np.cumsum(counts) - counts  # first row of each symbol
        self.bwts = {"left": forward, "right": reverse}
        self.rows = {}

    def _by_symbol(self, side: str) -> np.ndarray:
        """Row of the (k+1)-th symbol of the sorted column, in the BWT."""
        if side not in self.rows:
            self.rows[side] = _sorted(self.bwts[side], len(self.counts)).astype(np.int32)
        return self.rows[side]

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Intervals of all single symbols but 0."""
        return self.first[1:], self.first[1:], self.counts[1:]

    def extend(self, side: str, at: np.ndarray, rat: np.ndarray, size: np.ndarray):
        """Intervals one symbol longer to that side, of the given ones (all of
        one length), where the longer phrase's other part of that length is
        given too; and which given one each extends."""
        here, there = (at, rat) if side == "left" else (rat, at)
        text, by = self.bwts[side], self._by_symbol(side)
        to = np.empty(len(by), dtype=np.int32)
        to[by] = np.arange(len(by), dtype=np.int32)
        rows, owner = _runs(here, size)
        given = np.zeros(len(text), dtype=bool)
        given[rows] = True
        symbol = text[rows].astype(np.int64)
        order = _sorted(owner * len(self.counts) + symbol, len(size) * len(self.counts))
        rows, owner, symbol = rows[order], owner[order], symbol[order]
        new = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (symbol[1:] != symbol[:-1])])[:len(rows)])
        n = np.diff(np.append(new, len(rows)))
        start = to[rows[new]].astype(np.int64)  # the first row with that symbol goes to the interval's first row
        owner_of = owner[new]
        begins = np.cumsum(size) - size
        other = there[owner_of] + new - begins[owner_of]  # smaller symbols come first on the other side
        keep = (symbol[new] != 0) & given[start]
        start, other, n, owner_of = start[keep], other[keep], n[keep], owner_of[keep]
        return (start, other, n, owner_of) if side == "left" else (other, start, n, owner_of)

    def spell(self, at: np.ndarray, length: int) -> np.ndarray:
        """The symbols of the phrases whose intervals start at ``at``."""
        by, out = self._by_symbol("left"), np.empty((len(at), length), dtype=np.int64)
        for k in range(length):
            out[:, k] = np.searchsorted(self.first, at, side="right") - 1
            at = by[at]
        return out


def _word_hashes(langs: list[str], lang: np.ndarray, words: list[bytes]) -> np.ndarray:
    """Two 64-bit hashes of each symbol."""
    names = [x.encode() + b"\0" for x in langs]
    raw = b"".join([bytes(16), *(xxhash.xxh3_128_digest(names[k] + w) for k, w in zip(lang.tolist(), words, strict=True))])
    return np.frombuffer(raw, "<u8").reshape(-1, 2).T.copy()


def _grow(phrase: np.ndarray, word: np.ndarray, side: str, length: int) -> np.ndarray:
    """Hashes of phrases of ``length`` words and one more: a polynomial of the
    word hashes, whatever the order in which the words came."""
    return word * _POWERS[length] + phrase if side == "left" else phrase * _POWERS[1] + word


def build_index(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Written table of shard indexes: a row for each part of a shard; the first
    has its langs and their words."""
    ship(docs.sparkSession)

    def run(batches):
        seq, part = 0, TaskContext.get().partitionId()
        alphabet, ids, size = _Alphabet(), [], 0

        def shard():
            t = np.concatenate([np.zeros(1, np.int32), *ids])
            counts = np.bincount(t, minlength=len(alphabet.words) + 1).astype(np.int64)
            lang = np.array(alphabet.lang, np.int32)
            totals = np.bincount(lang, counts[1:], len(alphabet.langs)).astype(np.int64)
            whole = {"lang": lang.tobytes(), "words": b"\n".join(alphabet.words), "counts": counts.tobytes(),
                     "bwt": bwt(t).tobytes(), "rbwt": bwt(t[::-1]).tobytes()}
            parts = -(-sum(map(len, whole.values())) // PART_BYTES)
            for k in range(0, parts, _ROWS):
                some = range(k, min(k + _ROWS, parts))
                once = [None] * (len(some) - (k == 0))
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array([(part << 32) + seq] * len(some), pa.int64()), "part": pa.array(some, pa.int32()),
                    "langs": pa.array([list(alphabet.langs)][k:] + once, pa.list_(pa.string())),
                    "totals": pa.array([totals.tolist()][k:] + once, pa.list_(pa.int64()))}
                    | {c: pa.array([x[len(x) * p // parts:len(x) * (p + 1) // parts] for p in some], pa.binary())
                       for c, x in whole.items()})

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), utf8(b.column(1)), strict=True):
                for s in _slices((text or b"").lower()):
                    tokens = _TOKEN.findall(s)
                    if not tokens:
                        continue
                    lookup = alphabet.of("und" if lang is None else lang)
                    ids.append(np.fromiter(map(lookup.__getitem__, tokens), np.int32, len(tokens)))
                    ids.append(np.zeros(1, np.int32))
                    size += len(tokens)
                    if size >= SHARD_WORDS and s[-1] in _MARKS:
                        yield from shard()
                        seq, alphabet, ids, size = seq + 1, _Alphabet(), [], 0
                        release()
                if size >= SHARD_WORDS:
                    yield from shard()
                    seq, alphabet, ids, size = seq + 1, _Alphabet(), [], 0
                    release()
        if size:
            yield from shard()
        release()

    return stage(docs.select(F.col(lang_col).cast("string"), F.col(text_col).cast("string")).mapInArrow(run, _INDEX),
                 "phrase-index", _WRITE)


def _whole(t: pa.Table, column: str) -> bytes:
    """A shard's column, of its parts."""
    parts = t[column]
    return b"".join([parts[k].as_buffer() for k in np.argsort(t["part"].to_numpy()).tolist()])


def _numbers(t: pa.Table, column: str, kind) -> np.ndarray:
    return np.frombuffer(_whole(t, column), dtype=kind)


def _sides(level: int) -> str:
    """The side to which phrases of ``level`` words grow."""
    return "right" if level == 2 else "left"


class _Shard:
    """A shard's intervals, level by level, each sorted by hash."""

    def __init__(self, t: pa.Table, sides: set[str]):
        text = {s: _numbers(t, c, np.int32) for s, c in (("left", "bwt"), ("right", "rbwt")) if s in sides}
        raw = _whole(t, "words")
        self.words = raw.split(b"\n") if raw else []
        self.langs, self.lang = t["langs"].drop_null()[0].as_py(), _numbers(t, "lang", np.int32)
        self.index = PhraseIndex(_numbers(t, "counts", np.int64), text.get("left"), text.get("right"))
        self.shard, self.level = t.column("shard")[0].as_py(), 1
        self.hashes = _word_hashes(self.langs, self.lang, self.words)
        self._hold(self.hashes[:, 1:], *self.index.words())

    def _hold(self, h: np.ndarray, *interval: np.ndarray) -> None:
        order = np.argsort(h[0])
        self.h, self.interval = h[:, order], [x[order] for x in interval]

    def cuts(self, ranges: int) -> np.ndarray:
        """Where the phrases of each hash range begin."""
        edges = np.array([-(-(r << 64) // ranges) for r in range(ranges)], dtype=np.uint64)
        return np.append(np.searchsorted(self.h[0], edges), self.h.shape[1])

    def chosen(self, answers: pa.Table, ranges: int, column: str = "bits"):
        """The phrases marked by the answers of the ranges that had any."""
        cuts, flags = self.cuts(ranges), np.zeros(self.h.shape[1], dtype=bool)
        for r, x in zip(answers["range"].to_pylist(), answers["bits"].to_pylist(), strict=True):
            size = cuts[r + 1] - cuts[r]
            flags[cuts[r]:cuts[r + 1]] = np.unpackbits(np.frombuffer(x, np.uint8), count=size).astype(bool)
        return np.flatnonzero(flags)

    def grow(self, live: np.ndarray) -> None:
        """From the live phrases to those a word longer."""
        side = _sides(self.level)
        *interval, owner = self.index.extend(side, *(x[live] for x in self.interval))
        added = np.searchsorted(self.index.first, interval[0 if side == "left" else 1], side="right") - 1
        h = _grow(self.h[:, live][:, owner], self.hashes[:, added], side, self.level)
        self.level += 1
        self._hold(h, *interval)


def _at_level(index: pa.Table, answers: pa.Table, level: int, ranges: int, spell: bool = False):
    """The shard at ``level``, or, to spell, at every level on the way."""
    shard = _Shard(index, {_sides(k) for k in range(1, level)} | ({"left"} if spell else set()))
    kinds = answers["level"].to_numpy()
    while True:
        if spell or shard.level == level:
            yield shard
        if shard.level == level:
            return
        shard.grow(shard.chosen(answers.filter(pa.array(kinds == shard.level)), ranges))


def _index_columns(index: DataFrame, level: int, spell: bool = False) -> DataFrame:
    sides = {_sides(k) for k in range(1, level)} | ({"left"} if spell else set())
    return index.select("shard", "part", "langs", "lang", "words", "counts",
                        *[c for s, c in (("left", "bwt"), ("right", "rbwt")) if s in sides])


def _counted(index: DataFrame, answers: DataFrame, level: int, ranges: int) -> DataFrame:
    """One row a shard and hash range: hashes and counts of its phrases."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        release()  # of the shard before
        rows = []
        for shard in _at_level(left, right, level, ranges) if left.num_rows else ():
            cuts, n = shard.cuts(ranges), shard.interval[2].astype("<u4")
            delta = np.diff(shard.h[0], prepend=np.uint64(0)).astype("<u8")
            low = (shard.h[1] >> np.uint64(32)).astype("<u4")
            for r in np.flatnonzero(np.diff(cuts)).tolist():
                i, j = int(cuts[r]), int(cuts[r + 1])
                delta[i] = shard.h[0][i]
                rows.append((r, shard.shard, _by_byte(delta[i:j]), low[i:j].tobytes(), _by_byte(n[i:j])))
        cols = list(zip(*rows, strict=True)) if rows else [()] * 5
        kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
        return pa.table([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["range", "shard", "h", "g", "n"])

    rows = _index_columns(index, level).groupBy("shard").cogroup(answers.groupBy("shard"))
    return rows.applyInArrow(run, _COUNTS)


def _by_byte(x: np.ndarray) -> bytes:
    """All first bytes, all second bytes, ...; without the bytes that are 0 in all."""
    planes = x.view(np.uint8).reshape(len(x), x.itemsize).T
    used = np.flatnonzero(planes.any(axis=1))
    top = int(used[-1]) + 1 if len(used) else 1
    return bytes([top]) + np.ascontiguousarray(planes[:top]).tobytes()


def _from_bytes(raw: bytes, kind: str) -> np.ndarray:
    top = raw[0]
    planes = np.frombuffer(raw, np.uint8, offset=1).reshape(top, -1)
    out = np.zeros((planes.shape[1], np.dtype(kind).itemsize), dtype=np.uint8)
    out[:, :top] = planes.T
    return out.reshape(-1).view(kind)


def _answered(counted: DataFrame, level: int, least: int) -> DataFrame:
    """Written table of the ranges' answers: which phrases of each shard are
    frequent, and the counts of those that it is to spell. Of the shards that
    hold a phrase its hash chooses one, so that none spells many more than others."""
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("shard")
        h = [np.cumsum(_from_bytes(x, "<u8")) for x in t["h"].to_pylist()]
        sizes = [len(x) for x in h]
        h = np.concatenate(h)
        g = np.frombuffer(b"".join(t["g"].to_pylist()), "<u4")
        n = np.concatenate([_from_bytes(x, "<u4") for x in t["n"].to_pylist()]).astype(np.int64)
        order = np.lexsort((g, h))
        new = np.concatenate([[True], (np.diff(h[order]) != 0) | (np.diff(g[order]) != 0)])
        begins = np.flatnonzero(new)
        total = np.add.reduceat(n[order], begins)
        of = np.cumsum(new) - 1
        flags, first, sums = np.zeros(len(h), bool), np.zeros(len(h), bool), np.zeros(len(h), np.int64)
        flags[order] = total[of] >= least
        holders = np.diff(begins, append=len(h))
        chosen = order[begins + (g[order[begins]] % holders)]
        first[chosen] = total >= least
        sums[order] = total[of]
        out, at = [], 0
        for size in sizes:
            part = slice(at, at + size)
            out.append((np.packbits(flags[part]).tobytes(), np.packbits(first[part]).tobytes(),
                        sums[part][first[part]].astype("<i8").tobytes()))
            at += size
        bits, firsts, totals = zip(*out, strict=True)
        return pa.table({"shard": t["shard"], "level": pa.array([level] * len(sizes), pa.int32()), "range": t["range"],
                         "bits": pa.array(bits, pa.binary()), "first": pa.array(firsts, pa.binary()),
                         "total": pa.array(totals, pa.binary())})

    return stage(counted.groupBy("range").applyInArrow(run, _BITS), f"phrase-bits-{level}", {"compression": "zstd"},
                 batch_rows=_ROWS)


def _spelled(index: DataFrame, answers: DataFrame, ranges: int) -> DataFrame:
    """(lang, phrase, words, a): every frequent phrase once."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        release()
        parts = [pa.table({"lang": pa.array([], pa.string()), "phrase": pa.array([], pa.binary()),
                           "words": pa.array([], pa.int32()), "a": pa.array([], pa.int64())})]
        levels = right["level"].to_numpy()
        for shard in _at_level(left, right, DEPTH, ranges, spell=True) if left.num_rows else ():
            mine = right.filter(pa.array(levels == shard.level))
            mine = mine.set_column(mine.column_names.index("bits"), "bits", mine["first"]).sort_by("range")
            which = shard.chosen(mine, ranges)
            symbols = shard.index.spell(shard.interval[0][which], shard.level) - 1
            text = [b" ".join([shard.words[s] for s in row]) for row in symbols.tolist()]
            parts.append(pa.table({
                "lang": pa.array(shard.langs, pa.string()).take(pa.array(shard.lang[symbols[:, 0]])),
                "phrase": pa.array(text, pa.binary()), "words": pa.array(np.full(len(text), shard.level, np.int32)),
                "a": pa.array(np.frombuffer(b"".join(mine["total"].to_pylist()), "<i8"))}))
        return pa.concat_tables(parts)

    rows = _index_columns(index, DEPTH, spell=True).groupBy("shard").cogroup(answers.groupBy("shard"))
    return rows.applyInArrow(run, "lang string, phrase binary, words int, a long")


def _lang_words(index: DataFrame) -> DataFrame:
    """(lang, n): all word occurrences."""
    each = index.where("part = 0").select(F.explode(F.arrays_zip("langs", "totals")).alias("x"))
    return each.groupBy(F.col("x.langs").alias("lang")).agg(F.sum("x.totals").alias("n"))


def phrases(docs: DataFrame, least: int = 30, text_col: str = "text", lang_col: str = "lang",
            index: DataFrame | None = None) -> DataFrame:
    """Written table (lang, phrase, words, a) of all words and phrases of up to
    ``DEPTH`` words that occur ``least`` times or more in the lang."""
    spark = docs.sparkSession
    index = build_index(docs, text_col, lang_col) if index is None else index
    # a range's task gets about as many phrases as a shard holds
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), index.where("part = 0").count())
    answers = spark.createDataFrame([], _BITS)
    for level in range(1, DEPTH + 1):
        bits = _answered(_counted(index, answers, level, ranges), level, least)
        answers = bits if level == 1 else answers.unionByName(bits)
    found = _spelled(index, answers, ranges).withColumn("phrase", F.col("phrase").cast("string"))
    return stage(found, "phrases", batch_rows=_ROWS)


def extensions(found: DataFrame) -> DataFrame:
    """(lang, phrase, left_most, right_most): for phrases with a frequent
    longer one, the count of the most frequent extension to each side."""
    w = F.split("phrase", " ")
    longer = found.where("words > 1").select("lang", "words", "a", w.alias("w"))
    left = longer.select("lang", F.array_join(F.slice("w", F.lit(2), F.col("words") - 1), " ").alias("phrase"),
                         F.col("a").alias("l"), F.lit(0).cast("long").alias("r"))
    right = longer.select("lang", F.array_join(F.slice("w", F.lit(1), F.col("words") - 1), " ").alias("phrase"),
                          F.lit(0).cast("long").alias("l"), F.col("a").alias("r"))
    return left.unionByName(right).groupBy("lang", "phrase").agg(F.max("l").alias("left_most"),
                                                                 F.max("r").alias("right_most"))


def collocations(found: DataFrame, share: int = 80, scale: int = 2_000_000) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the phrases of two words or more: the
    cut with the lowest score counts, ties to the shorter first part. A phrase
    goes if a word more on one side keeps ``share`` percent of its count (a
    longer phrase that holds it is at most as frequent as one a word longer)."""
    cands = found.where("words > 1").withColumn("w", F.split("phrase", " "))
    cut = F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    cuts = cands.select("lang", "phrase", "words", "a", "w", cut)
    sides = F.explode(F.array(
        F.struct(F.lit(True).alias("first"), F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("part")),
        F.struct(F.lit(False).alias("first"),
                 F.array_join(F.slice("w", F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("part"))))
    parts = stage(cuts.select("lang", "phrase", "a", "k", sides.alias("s")).select("lang", "phrase", "a", "k", "s.*"),
                  "phrase-parts")
    counts = found.select("lang", F.col("phrase").alias("part"), F.col("a").alias("f"))
    met = parts.join(counts, ["lang", "part"]).groupBy("lang", "phrase", "a", "k").agg(
        F.max(F.when(F.col("first"), F.col("f"))).alias("l"), F.max(F.when(~F.col("first"), F.col("f"))).alias("r"))
    score = F.expr(f"cast(a as decimal(20,0)) * {scale} div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    best = met.withColumn("score", score).groupBy("lang", "phrase", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("b"))
    most = F.coalesce(F.greatest("left_most", "right_most"), F.lit(0))
    kept = best.join(extensions(found), ["lang", "phrase"], "left").where(
        most.cast("decimal(20,0)") * 100 < F.col("a").cast("decimal(20,0)") * share)
    return kept.select("lang", "phrase", "a", "b.l", "b.r", "b.score")


def digest(docs: DataFrame, top: int = 2000, least: int = 30) -> DataFrame:
    """Each lang's first ``top`` collocations with their rank and the lang's
    number of words."""
    index = build_index(docs)
    found = phrases(docs, least, index=index)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.col("phrase"))
    ranked = collocations(found).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(_lang_words(index), "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
