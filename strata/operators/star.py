"""Star-schema helpers: the calendar dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import date_key


def calendar_dimension(df: DataFrame, ts_column: str) -> DataFrame:
    """Gap-free calendar from the first to the last day of ``ts_column``.

    The bounds stay in a one-row DataFrame (a global min/max aggregate with
    partial evaluation) and are exploded on the executors, so the driver
    never sees them. Output size is the calendar span, not the data size."""
    bounds = df.agg(F.min(F.to_date(ts_column)).alias("lo"), F.max(F.to_date(ts_column)).alias("hi"))
    days = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("date"))
    weekday = F.dayofweek("date")
    parts = {"date_key": date_key("date"), "date": F.col("date"), "year_month": F.date_format("date", "yyyy-MM"),
             "year": F.year("date"), "month": F.month("date"), "quarter": F.quarter("date"),
             "weekday": weekday, "is_weekend": weekday.isin(1, 7)}
    return days.select(*[c.alias(n) for n, c in parts.items()])
