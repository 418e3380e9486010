"""Deterministic deduplication and latest-row-per-key.

Both are a ``row_number() == 1`` filter over a window partitioned by the
key. Catalyst turns that into a WindowGroupLimit: a partial limit runs on
each map partition before the shuffle, so a key holding a large share of
the rows sends at most one row per map partition across the network, and
the final limit keeps one. The ordering is always total (every remaining
column is appended as a tie-breaker), so the survivor does not depend on
partitioning or task timing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import all_of

_RN = "__strata_rn"


def _total_order(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> list[Column]:
    used = set(keys)
    rest = [F.col(c).asc_nulls_first() for c in sorted(df.columns) if c not in used]
    return list(order_by) + rest


def dedup(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column] = (),
          require_keys: bool = False) -> DataFrame:
    """Keep one row per ``keys``: the first by ``order_by``, then by every
    other column ascending (in the order of their names). NULL keys form their own group unless
    ``require_keys`` drops them first."""
    keys = list(keys)
    if require_keys:
        df = df.filter(all_of([F.col(k).isNotNull() for k in keys]))
    w = Window.partitionBy(*keys).orderBy(*_total_order(df, keys, order_by))
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[str],
                   tie_breakers: Sequence[str] = ()) -> DataFrame:
    """One row per key: the greatest ``newest_first`` values (NULLs last),
    ties broken by ``tie_breakers`` ascending, then by the other columns."""
    order = [F.col(c).desc_nulls_last() for c in newest_first]
    order += [F.col(c).asc_nulls_first() for c in tie_breakers]
    return dedup(df, keys, order)
