"""MinHash near-duplicate detection with sequential Bayesian verification.

1. Every text becomes its set of 5-word shingle hashes, a MinHash signature and
   banded keys. Documents with equal sets form one class; only a class's
   smallest id goes on.
2. Band buckets of two or more classes give candidates. Signatures are
   compared a batch of values at a time; a pair is dropped once the posterior
   probability that its similarity reaches the threshold falls below the chosen
   miss probability.
3. Survivors are verified on the full shingle sets, recomputed from the texts.
4. Components of the verified links.

A group of m near copies must not become m^2 pairs, and no link between
different texts may be lost. Star rounds come first: in every bucket that spans
components, one document (the smallest id, later one drawn by a hash) meets all
members outside its component, so a round costs a pair a member; the links
join components, and buckets that lie in one are closed. After ``star_rounds``
the buckets still open are finished in full: the members outside a bucket's
largest component meet all others, in blocks bounded by documents and by
shingles; those with a surviving partner in another component meet there again
with their texts, every such pair is verified inside the task, and only links
that join components leave it.

Band keys miss a pair at the threshold (0.85) with a chance of about 1e-6, the
Bayesian pruning with at most ``miss`` per batch.

Edge cases: NULL or blank texts have an empty set and are linked with nothing;
a text of fewer words than a shingle is one shingle; repeated rows stay
repeated (``keep_one`` keeps one), and where rows share an id but not a text, links are confirmed on
the smallest text; a NULL id joins its class but never stands for it; empty
input gives no rows; further columns pass through or are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected, doc_groups, fresh, ship, stage, utf8
from .words import NON_SPACE, hash_words, mix, windows

HASHES, BANDS = 120, 24
ROWS = HASHES // BANDS
#: signature values compared before each pruning step
STEPS = (16, 32, 56, 88, 120)
#: documents, and shingles, of a bucket compared at once
CHUNK, CHUNK_SHINGLES = 512, 400_000

_rng = np.random.default_rng(1729)
_MUL = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def least_matches(threshold: float, miss: float) -> list[int]:
    """Per step, the fewest equal values at which the posterior probability
    (uniform prior) of a similarity of at least ``threshold`` is ``miss`` or
    more: P(s >= t | m of n) = P(Binomial(n + 1, t) <= m)."""
    from math import comb
    out = []
    for n in STEPS:
        total = 0.0
        for m in range(n + 1):
            total += comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
            if total >= miss:
                out.append(m)
                break
    return out


def shingle_sets(raw: list[bytes | None], k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text (lower-cased A-Z)."""
    h, first, _, _ = hash_words(raw, NON_SPACE, True)
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        out.append(np.unique(windows(h[a:b], min(k, b - a))) if b > a else h[:0])
    return out


def _signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of 32-bit minima per non-empty set."""
    at = np.cumsum([0] + [len(s) for s in sets[:-1]])
    flat = np.concatenate(sets)
    sig = np.empty((len(sets), HASHES), dtype=np.uint32)
    for j in range(HASHES):
        sig[:, j] = np.minimum.reduceat(flat * _MUL[j] + _ADD[j], at) >> np.uint64(32)
    return sig


def sketch(docs: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """Written table (doc_id, n_shingles, set_key, sig, bands); the last three
    are NULL for empty sets. ``set_key`` is a 128-bit sum over the set, ``sig``
    16 bits of each minimum, ``bands`` the band keys."""
    ship(docs.sparkSession)

    def run(batches):
        for b in batches:
            texts = utf8(b.column(1))
            for i, j in doc_groups(texts, texts):
                sets = shingle_sets(texts[i:j], k)
                full = [x for x in range(j - i) if len(sets[x])]
                keys, sigs, bands = [None] * (j - i), [None] * (j - i), [None] * (j - i)
                if full:
                    sig = _signatures([sets[x] for x in full])
                    wide = sig.reshape(len(full), BANDS, ROWS).astype(np.uint64)
                    band = np.zeros((len(full), BANDS), dtype=np.uint64)
                    for r in range(ROWS):
                        band = mix(band * np.uint64(31) + wide[:, :, r] + np.arange(BANDS, dtype=np.uint64))
                    low = sig.astype("<u2")
                    for y, x in enumerate(full):
                        s = sets[x]
                        keys[x] = np.array([mix(s).sum(), mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum()],
                                           "<u8").tobytes()
                        sigs[x], bands[x] = low[y].tobytes(), band[y].view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(keys, pa.binary()), pa.array(sigs, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                    names=["doc_id", "n_shingles", "set_key", "sig", "bands"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return stage(rows.mapInArrow(
        run, "doc_id long, n_shingles long, set_key binary, sig binary, bands array<long>"), "near-sketch")


def _buckets(reps: DataFrame) -> DataFrame:
    """Written table (bucket, id, n) of the buckets with two or more classes;
    buckets with the same members are kept once."""
    keys = reps.select(F.col("rep").alias("id"), "n", F.posexplode("bands").alias("band", "key")).select(
        "id", "n", F.xxhash64("band", "key").alias("bucket"))
    keys = stage(keys, "near-bands")
    shared = stage(keys.groupBy("bucket").agg(F.count("*").alias("m")).where("m > 1"), "near-shared")
    keys = stage(keys.join(shared, "bucket"), "near-members")
    same = keys.groupBy("bucket").agg(F.min("m").alias("m"), F.min("id").alias("lo"),
                                      F.bit_xor(F.xxhash64("id")).alias("x"),
                                      F.bit_xor(F.xxhash64(F.lit(7), "id")).alias("y"))
    distinct = stage(same.groupBy("m", "x", "y", "lo").agg(F.min("bucket").alias("bucket")).select("bucket"),
                     "near-distinct")
    return stage(keys.select("bucket", "id", "n").join(distinct, "bucket"), "near-buckets")


def _open_members(buckets: DataFrame, state: DataFrame) -> DataFrame:
    """Written table (bucket, id, n, component) of the buckets that span
    components."""
    m = stage(buckets.join(state.select("id", "component"), "id"), "near-state")
    still = m.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    still = stage(still.where("lo < hi").select("bucket"), "near-open")
    return stage(m.join(still, "bucket"), "near-open-members")


def _star_pairs(members: DataFrame, turn: int) -> DataFrame:
    """Written table (a, b), a < b: in each bucket one document with all those
    outside its component."""
    rank = F.col("id") if turn == 0 else F.xxhash64(F.lit(turn), "id")
    centre = stage(members.groupBy("bucket").agg(F.min(F.struct(rank.alias("rank"), "id", "component")).alias("c")).select(
        "bucket", F.col("c.id").alias("_id"), F.col("c.component").alias("_component")), "near-centres")
    pairs = members.join(centre, "bucket").where("component <> _component")
    return stage(pairs.select(F.least("id", "_id").alias("a"), F.greatest("id", "_id").alias("b")).distinct(), "near-stars")


def _likely(pairs: DataFrame, signatures: DataFrame, least: list[int]) -> DataFrame:
    """Written table of the pairs that no pruning step drops."""
    one = signatures.select(F.col("id").alias("a"), F.col("sig").alias("sa"))
    two = signatures.select(F.col("id").alias("b"), F.col("sig").alias("sb"))
    rows = stage(pairs.join(one, "a"), "near-half").join(two, "b").select("a", "b", "sa", "sb")

    def run(batches):
        for t in batches:
            x, y = (np.frombuffer(b"".join(t.column(c).to_pylist()), "<u2").reshape(-1, HASHES) for c in ("sa", "sb"))
            keep, same, done = np.arange(len(x)), np.zeros(len(x), dtype=np.int64), 0
            for n, need in zip(STEPS, least, strict=True):
                same = same + (x[keep, done:n] == y[keep, done:n]).sum(axis=1)
                keep, same, done = keep[same >= need], same[same >= need], n
            yield t.select(["a", "b"]).take(pa.array(keep))

    return stage(rows.mapInArrow(run, "a long, b long"), "near-likely")


def _blocks(members: DataFrame, signatures: DataFrame) -> DataFrame:
    """Rows dealt to the blocks of each open bucket: a chunk of the documents
    outside its largest component (``left``) against a chunk of all of them.
    ``minor`` marks the former where they come as members of the second."""
    size = members.groupBy("bucket", "component").agg(F.count("*").alias("m"), F.sum("n").alias("n"))
    size = size.groupBy("bucket").agg(
        F.max(F.struct("m", "component", "n")).alias("top"), F.sum("m").alias("m"), F.sum("n").alias("n"))

    def chunks(m, n):
        return F.greatest(F.lit(1), F.ceil(m / CHUNK), F.ceil(n / CHUNK_SHINGLES)).cast("int")
    m, n = F.col("m"), F.col("n")
    size = stage(size.select("bucket", F.col("top.component").alias("largest"), chunks(m, n).alias("all_chunks"),
                             chunks(m - F.col("top.m"), n - F.col("top.n")).alias("left_chunks")), "near-sizes")
    rows = members.join(size, "bucket").withColumn("minor", F.col("component") != F.col("largest"))
    mine = F.xxhash64(F.lit(3), "id")
    of_left, of_all = (F.pmod(mine, F.col(c)).cast("int") for c in ("left_chunks", "all_chunks"))
    left = rows.where("minor").select("bucket", "id", "component", F.lit(True).alias("left"), F.lit(True).alias("minor"),
                                      of_left.alias("l"), F.explode(F.sequence(F.lit(0), F.col("all_chunks") - 1)).alias("r"))
    right = rows.select("bucket", "id", "component", F.lit(False).alias("left"), "minor",
                        F.explode(F.sequence(F.lit(0), F.col("left_chunks") - 1)).alias("l"), of_all.alias("r"))
    dealt = stage(left.unionByName(right), "near-dealt")
    return stage(dealt.join(signatures, "id").select(F.xxhash64("bucket", "l", "r").alias("block"), "left", "minor", "id",
                                                     "component", "sig"), "near-blocks")


def _survivors(t: pa.Table, least: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the pairs of different components that no pruning step drops."""
    ids, comp, sig = t["id"].to_numpy(), t["component"].to_numpy(), _sig(t)
    left, minor = (t[c].to_numpy() for c in ("left", "minor"))
    l, r = np.flatnonzero(left), np.flatnonzero(~left)
    found = []
    step = max(1, (1 << 16) // max(1, len(r)))  # bounds the gathered signatures
    for a in range(0, len(l), step):
        x = l[a:a + step]
        ok = comp[x][:, None] != comp[r][None, :]
        ok &= ~minor[r][None, :] | (ids[x][:, None] < ids[r][None, :])
        x, y = np.nonzero(ok)
        x, y = l[a:a + step][x], r[y]
        done, same = 0, np.zeros(len(x), dtype=np.int32)
        for n, need in zip(STEPS, least, strict=True):
            same = same + (sig[x, done:n] == sig[y, done:n]).sum(axis=1, dtype=np.int32)
            keep = same >= need
            x, y, same, done = x[keep], y[keep], same[keep], n
        found.append((x, y))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])


def _sig(t: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(t["sig"].to_pylist()), "<u2").reshape(-1, HASHES)


def _undecided(t: pa.Table, least: list[int]) -> list[tuple[int, int]]:
    """(block, id) of the documents with a survivor in another component."""
    lo, hi = _survivors(t, least)
    block = t["block"][0].as_py()
    return [(block, i) for i in np.unique(t["id"].to_numpy()[np.concatenate([lo, hi])]).tolist()]


def intersections(sets: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sizes of sets[x] & sets[y]: pair by pair, or for many pairs by products
    of 0/1 rows over slices of the shingles that two sets or more hold."""
    if len(x) < 4 * len(sets):
        return np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in zip(x, y, strict=True)],
                        dtype=np.int64)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, col, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    new = np.cumsum(n > 1) - 1
    row, col = row[n[col] > 1], new[col[n[col] > 1]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    both = np.zeros((len(sets), len(sets)), dtype=np.float32)
    for a in range(0, int(new[-1]) + 1, 2048):
        i, j = np.searchsorted(col, (a, a + 2048))
        m = np.zeros((len(sets), 2048), dtype=np.float32)
        m[row[i:j], col[i:j] - a] = 1
        both += m @ m.T
    return both[x, y].astype(np.int64)


def _joining_links(t: pa.Table, least: list[int], k: int, percent: int) -> list[tuple[int, int]]:
    """The verified links of a block, of those only a forest over components."""
    ids, comp = t["id"].to_numpy(), t["component"].to_numpy()
    lo, hi = _survivors(t, least)
    sets = shingle_sets(utf8(t["text"].combine_chunks()), k)
    size = np.array([len(s) for s in sets])
    both = intersections(sets, lo, hi)
    linked = 100 * both >= percent * (size[lo] + size[hi] - both)
    parent: dict[int, int] = {}

    def find(c: int) -> int:
        while parent.get(c, c) != c:
            parent[c] = c = parent.get(parent[c], parent[c])
        return c
    out = []
    for p, q in zip(lo[linked].tolist(), hi[linked].tolist(), strict=True):
        a, b = find(int(comp[p])), find(int(comp[q]))
        if a != b:
            parent[a] = b
            out.append((int(ids[p]), int(ids[q])))
    return out


def _per_block(rows: DataFrame, work, names: str) -> DataFrame:
    """``work`` on each block's rows, whole and sorted by id; it returns pairs
    of longs called ``names``. A task holds one block at a time: two chunks of
    at most about CHUNK documents and CHUNK_SHINGLES shingles."""
    rows = rows.repartition(F.col("block")).sortWithinPartitions("block", "id")
    first, second = names.split()

    def batch(out):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=[first, second])

    def run(batches):
        held: list[pa.RecordBatch] = []
        for b in batches:
            block = b.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
            out = []
            for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                if held and i == 0 and held[-1].column(0)[0].as_py() != block[0]:
                    out += work(pa.Table.from_batches(held))
                    held = []
                if j == len(block):
                    held.append(b.slice(i, j - i))
                else:
                    out += work(pa.Table.from_batches([*held, b.slice(i, j - i)]))
                    held = []
            if out:
                yield batch(out)
        if held and (out := work(pa.Table.from_batches(held))):
            yield batch(out)

    return rows.mapInArrow(run, f"{first} long, {second} long").distinct()


def _verified(pairs: DataFrame, texts: DataFrame, k: int, percent: int, per_group: int = 256) -> DataFrame:
    """Written table (a, b, linked): intersection and union of the full sets
    decide. Pairs are grouped by their smaller document, at most about
    ``per_group`` to a group, so its text is shipped once a group."""
    fan = pairs.groupBy("a").agg(F.ceil(F.count("*") / per_group).alias("groups"))
    g = stage(pairs.join(fan, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("groups"))).select(
        "a", "b", "salt"), "near-groups")
    members = g.select("a", "salt", F.col("b").alias("id")).unionByName(
        g.select("a", "salt", F.col("a").alias("id")).distinct())
    rows = members.join(texts, "id").repartition(F.col("a"), F.col("salt"))
    rows = rows.sortWithinPartitions("a", "salt", "id").select("a", "salt", "id", "text")

    def run(batches):
        group, base = None, None
        for b in batches:
            a, salt, ids = (b.column(c).to_pylist() for c in range(3))
            raw = utf8(b.column(3))
            for i, j in doc_groups(raw, raw):
                out = []
                for x, s in zip(range(i, j), shingle_sets(raw[i:j], k), strict=True):
                    if (a[x], salt[x]) != group:  # the group's own document comes first
                        group, base = (a[x], salt[x]), s
                        continue
                    both = len(np.intersect1d(base, s, assume_unique=True))
                    out.append((a[x], ids[x], 100 * both >= percent * (len(base) + len(s) - both)))
                if out:
                    p, q, v = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(p, pa.int64()), pa.array(q, pa.int64()),
                                                      pa.array(v, pa.bool_())], names=["a", "b", "linked"])

    return stage(rows.mapInArrow(run, "a long, b long, linked boolean"), "near-verified")


def components(docs: DataFrame, percent: int = 85, k: int = 5, miss: float = 1e-6, star_rounds: int = 3,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id): components of the links between
    documents whose shingle sets have 100 * intersection >= percent * union."""
    least = least_matches(percent / 100, miss)
    sketches = sketch(docs, k, id_col, text_col)
    full = sketches.where(F.col("set_key").isNotNull() & F.col("doc_id").isNotNull())
    reps = stage(full.groupBy("set_key").agg(
        F.min(F.struct("doc_id", "sig", "bands", "n_shingles")).alias("r")).select(
        "set_key", F.col("r.doc_id").alias("rep"), "r.sig", "r.bands", F.col("r.n_shingles").alias("n")), "near-reps")
    classes = reps.select("set_key", "rep")
    buckets = _buckets(reps)
    ids = stage(buckets.select("id").distinct(), "near-ids")
    known = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # the merge hint keeps the plan the same at every size
    texts = stage(known.hint("merge").join(ids, "id").groupBy("id").agg(F.min("text").alias("text")), "near-texts")
    signatures = stage(reps.select(F.col("rep").alias("id"), "sig").join(ids, "id"), "near-signatures")
    links: DataFrame | None = None
    reach: DataFrame | None = None
    for turn in range(star_rounds + 1):
        state = ids.withColumn("component", F.col("id")) if reach is None else ids.join(reach, "id", "left").select(
            "id", F.coalesce("component", "id").alias("component"))
        members = _open_members(buckets, state)
        if members.isEmpty():
            break
        if turn < star_rounds:
            checked = _verified(_likely(_star_pairs(members, turn), signatures, least), texts, k, percent)
            new = checked.where("linked").select("a", "b")
        else:
            blocks = _blocks(members, signatures)
            rest = stage(_per_block(blocks, lambda t: _undecided(t, least), "block id"), "near-undecided")
            if rest.isEmpty():
                break
            rows = stage(blocks.join(rest, ["block", "id"]), "near-rest").join(texts, "id").select(
                "block", "left", "minor", "id", "component", "sig", "text")
            new = _per_block(rows, lambda t: _joining_links(t, least, k, percent), "a b")
        links = stage(new if links is None else links.unionByName(new), "near-links")
        reach = connected(links)
    out = sketches.select("doc_id", "n_shingles", "set_key").join(classes, "set_key", "left")
    if reach is None:
        return out.select("doc_id", "n_shingles", F.coalesce("rep", "doc_id").alias("component_id"))
    reach = reach.select(F.col("id").alias("rep"), "component")
    return out.join(reach, "rep", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "rep", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: the smallest id,
    where ids repeat the smallest hash of id and text. Rows repeated in id and
    text, rows that share only an id, and rows with a NULL id are told apart by
    that hash; a NULL id stays only where the group has no other. Empty
    shingle sets are linked with nothing, so all their rows stay."""
    key, pick, size = (fresh(docs, c) for c in ("row_key", "picked_key", "group_rows"))
    keyed = docs.withColumn(key, F.xxhash64(id_col, text_col))
    groups = components(keyed, id_col=key, text_col=text_col, **options).where("n_shingles > 0").groupBy(
        F.col("doc_id").alias(key)).agg(F.min("component_id").alias("component"), F.count("*").alias(size))
    ids = keyed.groupBy(key).agg(F.min(id_col).alias("id"))
    groups = stage(groups.join(ids, key), "near-row-groups")
    first = groups.groupBy("component").agg(F.min(F.struct(F.col("id").isNull(), "id", key)).alias("x"))
    first = stage(first.select(F.col(f"x.{key}").alias(pick)), "near-picked")
    groups = groups.join(first, groups[key] == first[pick], "left").where(F.col(pick).isNull() | (F.col(size) > 1))
    groups = stage(groups.select(key, pick), "near-dropped")
    rest = keyed.join(groups.select(key), key, "left_anti").select(*docs.columns)
    again = keyed.join(groups.where(F.col(pick).isNotNull()).select(key), key, "left_semi")
    # grouped by a hash of the key: rows repeated very often meet as partial aggregates
    one = again.groupBy(F.xxhash64(key).alias(pick), key).agg(
        F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias(size))
    return rest.unionByName(one.select(f"{size}.*"))


def digest(docs: DataFrame) -> DataFrame:
    return components(docs).withColumn("kept", F.col("doc_id") == F.col("component_id"))
