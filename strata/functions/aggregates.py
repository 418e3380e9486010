"""Aggregate expressions used by the reports. All are built-in Spark
aggregates with partial (map-side) evaluation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import ColumnOrName, _c, round_half_up


def count_where(cond: Column) -> Column:
    """Number of rows where ``cond`` is true (NULL counts as false)."""
    return F.count_if(F.coalesce(cond, F.lit(False)))


def pct_where(cond: Column, digits: int | None = None) -> Column:
    """100 * share of rows where ``cond`` holds (NULL counts as not)."""
    share = F.avg(F.when(cond, F.lit(1)).otherwise(F.lit(0)).cast("double")) * 100.0
    return share if digits is None else round_half_up(share, digits)


def ratio_pct(numerator: ColumnOrName, denominator: ColumnOrName, digits: int | None = None) -> Column:
    """100 * sum(numerator) / sum(denominator); NULL when the denominator
    sums to zero. Sums are taken in the input type (exact for decimals) and
    divided once as doubles."""
    num = F.sum(_c(numerator)).cast("double")
    den = F.nullif(F.sum(_c(denominator)).cast("double"), F.lit(0.0))
    value = F.lit(100.0) * num / den
    return value if digits is None else round_half_up(value, digits)


def safe_corr(x: ColumnOrName, y: ColumnOrName) -> Column:
    """Pearson correlation that yields NULL (not an error) for fewer than
    two rows or a constant input."""
    xd, yd = _c(x).cast("double"), _c(y).cast("double")
    both = xd.isNotNull() & yd.isNotNull()
    xs, ys = F.when(both, xd), F.when(both, yd)
    den = F.stddev_pop(xs) * F.stddev_pop(ys)
    return F.covar_pop(xs, ys) / F.nullif(den, F.lit(0.0))


def avg_rounded(c: ColumnOrName, digits: int) -> Column:
    return round_half_up(F.avg(_c(c).cast("double")), digits)
