"""Report building blocks: share of total, top-k, value frequencies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import round_half_up


def share_of_total(grouped: DataFrame, measure: str, alias: str, digits: int | None = None) -> DataFrame:
    """Add ``alias`` = 100 * measure / sum of measure over all rows.

    The total is a window over the rows of ``grouped``, one per group, so the
    facts behind them are read once. The groups meet in one task: meant for
    report-sized groupings (``Sum`` in the measure's own type, so decimals stay
    exact)."""
    total = F.sum(F.col(measure)).over(Window.partitionBy(F.lit(0))).cast("double")
    value = F.lit(100.0) * F.col(measure).cast("double") / F.nullif(total, F.lit(0.0))
    return grouped.withColumn(alias, value if digits is None else round_half_up(value, digits))


def top_k(df: DataFrame, k: int, order_by: Sequence[Column]) -> DataFrame:
    """First ``k`` rows by ``order_by``. Planned as TakeOrderedAndProject:
    every partition keeps its own k best rows, then one merge of
    k x partitions rows; the input is never sorted as a whole."""
    return df.orderBy(*order_by).limit(k)


def frequency(df: DataFrame, column: str, domain: str | None = None) -> DataFrame:
    """Value counts of one column: (domain, value, n)."""
    out = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return out.select(F.lit(domain or column).alias("domain"), "value", "n")
