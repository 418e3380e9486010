"""Exact, repeatable quantiles from counts of distinct values.

1. Rows per (group, column, value): a partial and a final hash aggregate, so
   a value or group holding a large share of the rows costs one counter per
   map partition. All columns of a call share this one pass over the data.
2. Coarse buckets that keep the order of the values (steps of 1/4096 of an
   octave) are counted per group; a running sum over the buckets finds the
   bucket that holds each wanted rank. There are at most a few thousand
   buckets per octave of values, whatever the number of rows.
3. Inside that bucket only, a running sum over the distinct values gives the
   smallest value whose cumulative share is at least p (the lower quantile).

Without groups the buckets are wider (1/1024 of an octave) and counted straight
from the rows, and a second pass over the rows counts the values of the wanted
buckets: what moves is bounded by buckets and tasks, not by distinct values.

No step depends on the order of rows or partitions, so two runs agree. Count,
minimum, maximum and sum of each column come from the same buckets.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType
from pyspark.sql.window import Window

_KEY, _NAME, _V, _N, _K = "__key", "__name", "__value", "__n", "__bucket"
_INTEGRAL = (ByteType, ShortType, IntegerType, LongType)
_STEPS, _WIDE_STEPS = 4096, 1024
#: beyond every bucket of a finite double
_FAR = 1 << 40


def _coarse(v: Column, steps: int = _STEPS) -> Column:
    """A long that never decreases as the double ``v`` grows."""
    size = F.abs(v)
    step = F.floor(F.log2(size) * steps) + 2048 * steps
    bounded = F.when(size == float("inf"), F.lit(_FAR)).otherwise(step)
    return (F.when(F.isnan(v), F.lit(2 * _FAR)).when(v == 0, F.lit(0))
            .when(v > 0, bounded).otherwise(-bounded)).cast("long")


def _long(df: DataFrame, values: Mapping[str, Column], key: Column) -> DataFrame:
    # adding 0.0 makes -0.0 and 0.0 one value
    pairs = F.array(*[F.struct(F.lit(i).alias(_NAME), (c.cast("double") + F.lit(0.0)).alias(_V))
                      for i, c in enumerate(values.values())])
    return df.select(key.alias(_KEY), F.inline(pairs)).filter(F.col(_V).isNotNull())


def _counts(df: DataFrame, values: Mapping[str, Column], group_by: Sequence[str]) -> DataFrame:
    per_value = _long(df, values, F.struct(*[F.col(g) for g in group_by])).groupBy(_KEY, _NAME, _V).agg(F.count(F.lit(1)).alias(_N))
    return per_value.withColumn(_K, _coarse(F.col(_V)))


def _holding(b: DataFrame, probs: Sequence[float]) -> DataFrame:
    """The buckets (with ``upto`` and ``total``) that hold a wanted rank, once a ``p``."""
    ranks = F.array(*[F.struct(F.lit(i).alias("p"), F.lit(str(p)).cast("decimal(20,18)").alias("share"))
                      for i, p in enumerate(probs)])
    b = b.select("*", F.inline(ranks)).withColumn(
        "rank", F.greatest(F.ceil(F.col("share") * F.col("total")).cast("long"), F.lit(1).cast("long")))
    return b.filter((F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col(_N)))


def _whole_stats(df: DataFrame, values: Mapping[str, Column], probs: Sequence[float]) -> DataFrame:
    """(name, p, value, n, lo, hi, sum), a row for each p of a column with values."""
    long = _long(df, values, F.lit(0)).withColumn(_K, _coarse(F.col(_V), _WIDE_STEPS))
    buckets = long.groupBy(_NAME, _K).agg(F.count(F.lit(1)).alias(_N), F.min(_V).alias("lo"), F.max(_V).alias("hi"),
                                          F.sum(_V).alias("sum"))
    group = Window.partitionBy(_NAME)
    running = group.orderBy(_K).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    b = buckets.select(_NAME, _K, _N, F.sum(_N).over(running).alias("upto"), F.sum(_N).over(group).alias("total"),
                       F.min("lo").over(group).alias("lo"), F.max("hi").over(group).alias("hi"),
                       F.sum("sum").over(group).alias("sum"))
    # a row a column and probability
    wanted = F.broadcast(_holding(b, probs or [0.5]).select(
        F.col(_NAME).alias("__m"), F.col(_K).alias("__b"), "p", (F.col("rank") - F.col("upto") + F.col(_N)).alias("rank"),
        "total", "lo", "hi", "sum"))
    inside = long.join(wanted, (F.col(_NAME) == F.col("__m")) & (F.col(_K) == F.col("__b")))
    told = [F.max(c).alias(c) for c in ("rank", "total", "lo", "hi", "sum")]
    per_value = inside.groupBy(_NAME, "p", _V).agg(F.count(F.lit(1)).alias(_N), *told)
    running = Window.partitionBy(_NAME, "p").orderBy(_V).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = per_value.withColumn("upto", F.sum(_N).over(running)).filter("upto >= rank")
    return found.groupBy(_NAME, "p").agg(F.min(_V).alias("value"), F.max("total").alias(_N), *told[2:])


def _long_quantiles(counts: DataFrame, buckets: DataFrame, probs: Sequence[float]) -> DataFrame:
    """(key, name, p, value)."""
    group = Window.partitionBy(_KEY, _NAME)
    running = group.orderBy(_K).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    b = buckets.select(_KEY, _NAME, _K, _N, F.sum(_N).over(running).alias("upto"), F.sum(_N).over(group).alias("total"))
    wanted = _holding(b, probs).select(
        F.col(_KEY).alias("__k"), F.col(_NAME).alias("__m"), F.col(_K).alias("__b"), "p",
        (F.col("rank") - F.col("upto") + F.col(_N)).alias("rank"))
    # null-safe keys keep both uses of the counts alike, so their shuffle is reused
    inside = counts.join(wanted, counts[_KEY].eqNullSafe(wanted["__k"]) & counts[_NAME].eqNullSafe(wanted["__m"])
                         & counts[_K].eqNullSafe(wanted["__b"]))
    running = Window.partitionBy(_KEY, _NAME, "p").orderBy(_V).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = inside.select(_KEY, _NAME, "p", "rank", _V, F.sum(_N).over(running).alias("upto"))
    return inside.filter("upto >= rank").groupBy(_KEY, _NAME, "p").agg(F.min(_V).alias("value"))


def quantile_stats(df: DataFrame, values: Mapping[str, Column], probs: Sequence[float],
                   group_by: Sequence[str] = ()) -> DataFrame:
    """One row per group (one row in all without ``group_by``) and, per named
    column, ``<name>__n``, ``__min``, ``__max``, ``__sum`` and ``__q0``,
    ``__q1``, ... as doubles; NULL values are ignored. A group without any
    value is left out, the single row without groups is always there."""
    if not group_by:
        whole, parts = _whole_stats(df, values, probs), []
        for i, n in enumerate(values):
            of = [F.max(F.when(F.col(_NAME) == i, F.col(c))) for c in (_N, "lo", "hi", "sum")]
            parts += [F.coalesce(of[0], F.lit(0).cast("long")).alias(f"{n}__n"), of[1].alias(f"{n}__min"),
                      of[2].alias(f"{n}__max"), of[3].alias(f"{n}__sum")]
            parts += [F.max(F.when((F.col(_NAME) == i) & (F.col("p") == j), F.col("value"))).alias(f"{n}__q{j}")
                      for j in range(len(probs))]
        return whole.agg(*parts)
    counts = _counts(df, values, group_by)
    buckets = counts.groupBy(_KEY, _NAME, _K).agg(
        F.sum(_N).alias(_N), F.min(_V).alias("lo"), F.max(_V).alias("hi"), F.sum(F.col(_V) * F.col(_N)).alias("sum"))
    found = _long_quantiles(counts, buckets, probs)
    # both kinds of result rows meet in one aggregate, so the counts behind them are one shuffle
    empty = {c: F.lit(None).cast("double") for c in ("lo", "hi", "sum", "value")}
    rows = buckets.select(_KEY, _NAME, _N, "lo", "hi", "sum", F.lit(-1).alias("p"), empty["value"].alias("value")).unionAll(
        found.select(_KEY, _NAME, F.lit(0).cast("long").alias(_N), *[empty[c].alias(c) for c in ("lo", "hi", "sum")],
                     "p", "value"))
    parts = []
    for i, n in enumerate(values):
        mine = F.col(_NAME) == i
        parts += [F.coalesce(F.sum(F.when(mine, F.col(_N))), F.lit(0)).alias(f"{n}__n"),
                  F.min(F.when(mine, F.col("lo"))).alias(f"{n}__min"), F.max(F.when(mine, F.col("hi"))).alias(f"{n}__max"),
                  F.sum(F.when(mine, F.col("sum"))).alias(f"{n}__sum")]
        parts += [F.max(F.when(mine & (F.col("p") == j), F.col("value"))).alias(f"{n}__q{j}") for j in range(len(probs))]
    names = [c for c in rows.groupBy(_KEY).agg(*parts).columns if c != _KEY]
    return rows.groupBy(_KEY).agg(*parts).select(f"{_KEY}.*", *names)


def quantiles(df: DataFrame, value: Column | str, probs: Sequence[float], group_by: Sequence[str] = (),
              names: Sequence[str] | None = None, cast: str | None = None) -> DataFrame:
    """(group_by..., one column per probability). Integral columns give longs;
    ``cast`` sets another output type. Groups without values are left out."""
    v = F.col(value) if isinstance(value, str) else value
    kind = cast or ("long" if isinstance(df.select(v.alias(_V)).schema[_V].dataType, _INTEGRAL) else "double")
    names = list(names) if names else [f"q{p}" for p in probs]
    stats = quantile_stats(df, {"__x": v}, probs, group_by)
    return stats.select(*group_by, *[F.col(f"__x__q{i}").cast(kind).alias(n) for i, n in enumerate(names)])
