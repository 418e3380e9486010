"""Exact top-k by inner product with multi-resolution segment statistics.

Vectors are cut into segments; a segment's mean and deviation bound what it
can add to an inner product (for segments of n components, at most
n * (mean * mean' + deviation * deviation'), which is the lower bound of the
squared distance by means and deviations, rewritten with the exact norms).

Candidates are ordered by their nearest pivot (vectors of a bounded sample) and
norm and packed into blocks; of each block an envelope is kept, the range of
the segment means and the largest deviations. A query's limit is its k-th best
score among the sample. Before anything large moves, blocks of queries meet
the envelopes: a block of candidates goes only to the query blocks of which
some query's bound over the envelope reaches its limit. Inside a task pairs
are bounded over few segments first, over more next, each pair by itself, and
only survivors are multiplied out; blocks come best bound first, and every
block raises the limits. Limits prune only, so results are exact.

Edge cases: vectors that are NULL, empty or hold NULL or non-finite components
take no part; components are exact at every size (an inner product beyond 2^53
is summed in whole numbers of any length; a score that a long can't hold is
ranked exactly and returned as the nearest long; 64 times a component beyond
the range of a double counts as the largest double); vectors of different
lengths are not compared; rows sharing a query's id are its own; a repeated
query is answered once a row; fewer candidates than k are all returned; empty
tables give no rows; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ship, stage

QUERY_BLOCK, CANDIDATE_BLOCK = 256, 1024
#: candidates that set a query's first limit, and those of them that order the blocks
SAMPLE, PIVOTS = 2048, 64
#: envelopes that a query block meets at a time
ENVELOPES = 4096
SEGMENTS = (4, 16, 32)
_MOST = np.finfo(np.float64).max


def quantised(vectors: pa.Array, scale: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """(places, vectors) of the usable vectors as floor(scale * x), whole
    numbers held exactly in doubles."""
    places, out = [], []
    for i, v in enumerate(vectors):
        if not v.is_valid or not len(v.values) or v.values.null_count:
            continue
        x = v.values.to_numpy().astype(np.float64)
        if np.isfinite(x).all():
            places.append(i)
            with np.errstate(over="ignore"):
                out.append(np.clip(np.floor(scale * x), -_MOST, _MOST))
    return np.array(places, dtype=np.int64), out


def norms(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.minimum(np.sqrt((x ** 2).sum(axis=1)), _MOST)


def statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Per row: root of the size times mean, and times deviation, of each
    segment. The inner product of two rows bounds that of the vectors."""
    cuts = np.unique(np.linspace(0, x.shape[1], min(segments, x.shape[1]) + 1).astype(int))
    means, devs = [], []
    with np.errstate(over="ignore", invalid="ignore"):
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            part = x[:, a:b]
            m = part.mean(axis=1)
            means.append(np.sqrt(b - a) * m)
            devs.append(np.sqrt(((part - m[:, None]) ** 2).sum(axis=1)))
    return np.stack(means + devs, axis=1)


def envelope(stats: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, most) of each statistic of a block."""
    return stats.min(axis=0), stats.max(axis=0)


def over_envelopes(stats: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Bounds of the inner products of rows (their statistics) with every
    vector of the blocks. A deviation is never negative, so its most counts."""
    with np.errstate(over="ignore", invalid="ignore"):
        return np.maximum(stats, 0) @ most.T + np.minimum(stats, 0) @ least.T


def slack(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """What rounding can take from a bound, at most, of rows with these norms."""
    with np.errstate(over="ignore"):
        return 1e-9 * np.multiply.outer(q, c) + 1e-6


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products: doubles where these hold them, else Python's
    whole numbers."""
    top = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(1, q.shape[1])
    if top < 2.0 ** 53:
        return q @ c.T
    whole = np.frompyfunc(int, 1, 1)
    return whole(q) @ whole(c).T


class _Best:
    """The k best (score, id) of each query of a block so far."""

    def __init__(self, ids: np.ndarray, q: np.ndarray, limit: np.ndarray, k: int):
        self.ids, self.q, self.k = ids, q, k
        self.limit = limit.astype(np.float64)
        self.norm = norms(q)
        self.stats = [statistics(q, s) for s in SEGMENTS]
        self.found: list[list[tuple]] = [[] for _ in ids]
        self.met = self.multiplied = 0

    def see(self, ids: np.ndarray, c: np.ndarray) -> None:
        self.met += len(self.ids) * len(ids)
        alive = self.ids[:, None] != ids[None, :]
        room = slack(self.norm, norms(c))
        for mine, s in zip(self.stats, SEGMENTS, strict=True):
            rows, cols = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
            if not len(rows):
                return
            part = np.ix_(rows, cols)
            with np.errstate(over="ignore", invalid="ignore"):  # what overflows is not dropped
                bound = mine[rows] @ statistics(c[cols], s).T
                alive[part] &= ~(bound + room[part] < self.limit[rows][:, None])
        self.multiplied += int(alive.sum())
        if alive.mean() > 0.05:  # one product of matrices costs less than picking pairs
            rows, cols = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
            if len(rows):
                scores = products(self.q[rows], c[cols])
                for i, r in enumerate(rows.tolist()):
                    keep = np.flatnonzero(alive[r, cols])
                    self._take(r, scores[i][keep], ids[cols[keep]])
            return
        for r in np.flatnonzero(alive.any(axis=1)).tolist():
            cols = np.flatnonzero(alive[r])
            self._take(r, products(self.q[r:r + 1], c[cols])[0], ids[cols])

    def _take(self, r: int, scores: np.ndarray, ids: np.ndarray) -> None:
        good = scores >= self.limit[r] if scores.dtype != object else np.ones(len(scores), bool)
        new = zip(map(int, scores[good].tolist()), ids[good].tolist(), strict=True)
        best = sorted([*self.found[r], *((-s, i) for s, i in new)])[:self.k]
        self.found[r] = best
        if len(best) == self.k:
            worst = float(max(-int(_MOST), min(int(_MOST), -best[-1][0])))
            self.limit[r] = max(self.limit[r], worst - 1e-15 * abs(worst))


def _packed(x: np.ndarray) -> tuple[str, bytes]:
    """Four bytes a component where they fit, else doubles."""
    kind = "<i4" if np.abs(x).max(initial=0) < 2.0 ** 31 else "<f8"
    return kind, x.astype(kind).tobytes()


def _unpack(ids: bytes, kind: str, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    i = np.frombuffer(ids, np.int64)
    return i, np.frombuffer(data, kind).astype(np.float64).reshape(len(i), -1)


_BLOCKS = "dim int, part int, no int, ids binary, kind string, data binary, least binary, most binary, limits binary"


def _sample(v: DataFrame, scale: int, seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(ids, vectors) of SAMPLE rows, by dimension."""
    drawn = v.orderBy(F.xxhash64(F.lit(seed), "id"), "id").limit(SAMPLE).select("id", "v").toArrow()
    by_dim: dict[int, list] = {}
    for b in drawn.to_batches():
        ids = b.column(0).to_pylist()
        for p, x in zip(*quantised(b.column(1), scale), strict=True):
            by_dim.setdefault(len(x), []).append((ids[p], x))
    return [(np.array([i for i, _ in r], np.int64), np.stack([x for _, x in r])) for r in by_dim.values()]


def _blocks(v: DataFrame, size: int, scale: int, sample, name: str, k: int | None = None) -> DataFrame:
    """Written table of blocks of similar vectors, with their envelopes over
    the middle resolution, and with the limits of their rows where ``k`` is given."""
    pivots = {x.shape[1]: x[:PIVOTS] / np.maximum(1, norms(x[:PIVOTS]))[:, None] for _, x in sample}

    def rows(batches):
        for b in batches:
            places, xs = quantised(b.column(1), scale)
            if not len(places):
                continue
            with np.errstate(over="ignore", invalid="ignore"):
                near = [int(np.argmax(pivots[len(x)] @ x)) if len(x) in pivots else 0 for x in xs]
                norm = [float(norms(x[None])[0]) for x in xs]
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(x) for x in xs], pa.int32()), pa.array(near, pa.int32()), pa.array(norm, pa.float64()),
                 b.column(0).take(pa.array(places)), pa.array([x.tobytes() for x in xs], pa.binary())],
                names=["dim", "pivot", "norm", "id", "data"])

    def block(batches):
        part, no = TaskContext.get().partitionId(), 0
        held: list[tuple[int, int, bytes]] = []

        def row():
            nonlocal no
            ids, x = np.array([i for _, i, _ in held]), np.stack([np.frombuffer(d) for _, _, d in held])
            no += 1
            least, most = envelope(statistics(x, SEGMENTS[1]))
            limits = np.zeros(0)
            if k:
                best = _Best(ids, x, np.full(len(ids), -np.inf), k)
                for sids, sx in sample:
                    if sx.shape[1] == x.shape[1]:
                        best.see(sids, sx)
                limits = best.limit
            kind, data = _packed(x)
            return pa.RecordBatch.from_pylist([dict(zip(
                [f.split()[0] for f in _BLOCKS.split(", ")],
                [x.shape[1], part, no, ids.tobytes(), kind, data, least.tobytes(), most.tobytes(), limits.tobytes()],
                strict=True))], schema)
        for b in batches:
            for r in zip(*(b.column(c).to_pylist() for c in ("dim", "id", "data")), strict=True):
                if held and (len(held) == size or held[0][0] != r[0]):
                    yield row()
                    held.clear()
                held.append(r)
        if held:
            yield row()

    schema = pa.schema([("dim", pa.int32()), ("part", pa.int32()), ("no", pa.int32()), ("ids", pa.binary()),
                        ("kind", pa.string()), *((c, pa.binary()) for c in ("data", "least", "most", "limits"))])
    order = ["dim", "pivot", "norm", "id"]
    placed = stage(v.select("id", "v").mapInArrow(rows, "dim int, pivot int, norm double, id long, data binary"), f"{name}-rows")
    parts = max(1, int(v.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = placed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return stage(placed.select("dim", "id", "data").mapInArrow(block, _BLOCKS), name)


def _meetings(queries: DataFrame, candidates: DataFrame) -> DataFrame:
    """Written table (dim, qpart, qno, c, bound): the candidate blocks that can
    hold one of the k best of some query of a block. Only envelopes, limits
    and the queries' blocks are read."""
    rows = candidates.select("dim", "c", "least", "most", F.floor(F.col("c") / ENVELOPES).alias("g"))
    groups = rows.groupBy("dim", "g").agg(F.collect_list(F.struct("c", "least", "most")).alias("blocks"))
    counts = rows.groupBy("dim").agg(F.countDistinct("g").alias("groups"))
    dealt = queries.join(counts, "dim").withColumn("g", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)))
    pairs = dealt.join(groups, ["dim", "g"]).select("dim", "part", "no", "ids", "kind", "data", "limits", "blocks")

    def run(batches):
        for b in batches:
            out = []
            for r in b.to_pylist():
                _, q = _unpack(r["ids"], r["kind"], r["data"])
                stats, limit = statistics(q, SEGMENTS[1]), np.frombuffer(r["limits"])
                least, most = (np.stack([np.frombuffer(x[c]) for x in r["blocks"]]) for c in ("least", "most"))
                bound = over_envelopes(stats, least, most)
                far = norms(np.maximum(np.abs(least), np.abs(most)))
                with np.errstate(over="ignore", invalid="ignore"):
                    over = bound + slack(norms(q), far) - np.where(np.isfinite(limit), limit, -_MOST)[:, None]
                best = np.nan_to_num(over, nan=_MOST, posinf=_MOST, neginf=-_MOST).max(axis=0)
                for k in np.flatnonzero(best >= 0).tolist():
                    out.append((r["dim"], r["part"], r["no"], r["blocks"][k]["c"], float(best[k])))
            cols = list(zip(*out, strict=True)) if out else [()] * 5
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                             names=["dim", "qpart", "qno", "c", "over"])
    return stage(pairs.mapInArrow(run, "dim int, qpart int, qno int, c int, over double"), "topk-meetings")


def search(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64, spread: int = 4,
           id_col: str = "vec_id", vector_col: str = "embedding", seed: int = 3, shares: list | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``vectors`` where
    ``is_query`` holds, the ``k`` other rows of largest inner product of
    floor(scale * x), ties to the smaller id. ``shares`` gets the numbers of
    pairs there are, of pairs in blocks that meet, and of pairs multiplied out."""
    spark = vectors.sparkSession
    ship(spark)
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"), is_query.alias("q"))
    v = v.where("id is not null")
    sample = _sample(v, scale, seed)  # SAMPLE vectors at most
    order = Window.partitionBy("dim").orderBy("part", "no")  # a row a block
    blocks = _blocks(v, CANDIDATE_BLOCK, scale, sample, "topk-candidates")
    numbers = blocks.select("dim", "part", "no", (F.row_number().over(order) - 1).alias("c"))
    candidates = blocks.join(numbers, ["dim", "part", "no"])
    queries = _blocks(v.where("q"), QUERY_BLOCK, scale, sample, "topk-queries", k)
    meetings = _meetings(queries, candidates)
    asked = queries.select("dim", F.col("part").alias("qpart"), F.col("no").alias("qno"), F.col("ids").alias("qids"),
                           F.col("kind").alias("qkind"), F.col("data").alias("qdata"), "limits")
    pairs = meetings.join(asked, ["dim", "qpart", "qno"]).join(candidates.select("dim", "c", "ids", "kind", "data"), ["dim", "c"])
    pairs = pairs.withColumn("turn", F.pmod("c", F.lit(spread))).repartition("qpart", "qno", "dim", "turn")
    pairs = pairs.sortWithinPartitions("qpart", "qno", "dim", "turn", F.desc("over")).select(
        "qpart", "qno", "dim", "turn", "qids", "qkind", "qdata", "limits", "ids", "kind", "data")

    def run(batches):
        key, best = None, None

        def rows():
            n = [len(f) for f in best.found]
            at = np.repeat(np.arange(len(n)), n)
            flat = [x for f in best.found for x in f]
            top = (1 << 63) - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), key[0], np.int32)), pa.array(np.full(len(at), key[1], np.int32)),
                 pa.array(np.full(len(at), key[2], np.int32)), pa.array(at), pa.array(best.ids[at]),
                 pa.array([i for _, i in flat], pa.int64()), pa.array([max(-top, min(top, -s)) for s, _ in flat], pa.int64()),
                 pa.array([str(-s).rjust(700) if abs(s) > top else None for s, _ in flat], pa.string()),
                 pa.array(np.full(len(at), best.met)), pa.array(np.full(len(at), best.multiplied))], names=names)
        for b in batches:
            for r in b.to_pylist():
                now = (r["qpart"], r["qno"], r["dim"], r["turn"])
                if now != key:
                    if best:
                        yield from rows()
                    ids, q = _unpack(r["qids"], r["qkind"], r["qdata"])
                    key, best = now, _Best(ids, q, np.frombuffer(r["limits"]), k)
                best.see(*_unpack(r["ids"], r["kind"], r["data"]))
        if best:
            yield from rows()

    schema = ("qpart int, qno int, qdim int, qrow long, query_id long, vec_id long, score long, beyond string, "
              "met long, multiplied long")
    names = [f.split()[0] for f in schema.split(", ")]
    found = pairs.mapInArrow(run, schema)
    if shares is not None:
        found = stage(found, "topk-found")
        each = found.groupBy("qpart", "qno", "qdim", "met", "multiplied").agg(F.lit(1)).agg(F.sum("met"), F.sum("multiplied"))
        shares += [v.where("q").count() * v.count(), *each.first()]
    # scores beyond a long: the longer positive number is larger, the longer negative one smaller
    size = F.coalesce(F.when(F.col("score") > 0, F.length(F.trim("beyond"))).otherwise(-F.length(F.trim("beyond"))), F.lit(0))
    text = F.when(F.col("score") > 0, F.col("beyond"))
    back = F.when(F.col("score") < 0, F.col("beyond"))
    rank = F.row_number().over(Window.partitionBy("qpart", "qno", "qdim", "query_id", "qrow").orderBy(
        F.desc("score"), size.desc(), text.desc(), back.asc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def digest(embeddings: DataFrame) -> DataFrame:
    return search(embeddings, F.col("vec_id") % 20 == 0)
