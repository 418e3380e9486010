"""Skew-safe equi-join of a large table with a table that is unique per key.

A key can hold a large share of the rows (one order with a third of all
items). A plain shuffle join sends all of that key's rows to one task.
AQE's skew split only applies when both join inputs are fresh shuffle
stages. Where an input comes out of a window or aggregate that already
partitions by the key, it cannot apply, and this join handles the key
explicitly (for a counting pass, so it is opt-in):

1. rows per key on the large side (partial + final hash aggregate);
2. a key is hot when it holds more than ``skew_factor`` times the rows of
   an average shuffle partition (total / partitions); there are fewer
   than ``partitions / skew_factor`` such keys, so that list is a
   provably small broadcast whatever the data size;
3. each row of a hot key gets a salt in ``[0, splits)``, with ``splits``
   chosen so one split holds about an average partition's worth of rows;
   rows with a NULL key (they never match) are spread the same way;
4. the unique side's row of each hot key is replicated once per salt
   (in total at most about as many extra rows as there are shuffle
   partitions), all other rows get salt 0;
5. one shuffle join on (key, salt).

No pair explosion occurs (the small side has one row per (key, salt)),
nothing is collected to the driver, and the result equals the plain
join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import all_of

DEFAULT_SKEW_FACTOR = 2.0
_SALT, _SPLITS, _N = "__salt", "__splits", "__n"


def hot_keys(df: DataFrame, keys: Sequence[str], skew_factor: float = DEFAULT_SKEW_FACTOR,
             partitions: int | None = None) -> DataFrame:
    """(keys..., __splits) for the non-NULL keys of ``df`` holding more than
    ``skew_factor`` average partitions of rows; fewer than
    ``partitions / skew_factor`` rows. ``__splits`` spreads each key over
    pieces of about one average partition."""
    keys = list(keys)
    parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(_N))
    total = counts.agg(F.sum(_N)).scalar()
    share = F.col(_N) * F.lit(parts) / total           # size in average partitions
    return counts.filter(all_of([F.col(k).isNotNull() for k in keys]) & (share > F.lit(skew_factor))) \
                 .select(*keys, F.ceil(share).cast("int").alias(_SPLITS))


def salted_join(big: DataFrame, unique: DataFrame, keys: Sequence[str], how: str = "inner",
                skew_factor: float = DEFAULT_SKEW_FACTOR, partitions: int | None = None,
                split_by: Sequence[str] | None = None) -> DataFrame:
    """``big JOIN unique USING (keys)`` for ``how`` in inner, left,
    left_anti, left_semi, with hot keys of ``big`` salted. ``unique`` must
    hold at most one row per key. The salt is a hash of the ``split_by``
    columns (all columns where not given), which must differ among the rows of
    a key: equal rows stay together."""
    split = F.xxhash64(*[F.col(c) for c in split_by or big.columns])
    keys = list(keys)
    parts = partitions or int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = F.broadcast(hot_keys(big, keys, skew_factor, parts))
    null_key = ~all_of([F.col(k).isNotNull() for k in keys])
    salt = (F.when(null_key, F.pmod(split, F.lit(parts)))
             .when(F.col(_SPLITS).isNotNull(), F.pmod(split, F.col(_SPLITS)))
             .otherwise(F.lit(0))).cast("int")
    b = big.join(hot, keys, "left").withColumn(_SALT, salt).drop(_SPLITS)
    salts = F.when(F.col(_SPLITS).isNull(), F.array(F.lit(0))) \
             .otherwise(F.sequence(F.lit(0), F.col(_SPLITS) - 1))
    u = unique.join(hot, keys, "left").withColumn(_SALT, F.explode(salts)).drop(_SPLITS)
    out = b.join(u, keys + [_SALT], how).drop(_SALT)
    return out
