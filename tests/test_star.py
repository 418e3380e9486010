import datetime as dt

from pyspark.sql import functions as F

from strata.operators.star import calendar_dimension
from strata.plans.medallion import Medallion


def test_calendar_is_gap_free(spark):
    df = spark.createDataFrame([(dt.datetime(2017, 12, 30, 10),), (dt.datetime(2018, 1, 2, 8),), (None,)],
                               "ts timestamp_ntz")
    cal = calendar_dimension(df, "ts").orderBy("date").collect()
    assert [r.date_key for r in cal] == [20171230, 20171231, 20180101, 20180102]
    sat = cal[0]
    assert (sat.weekday, sat.is_weekend, sat.year_month, sat.quarter) == (7, True, "2017-12", 4)
    assert (cal[2].weekday, cal[2].is_weekend) == (2, False)


def test_fact_keeps_every_item_and_flags(spark, small_dir):
    m = Medallion(spark, small_dir)
    fact, items = m.gold["fact_order_items"], m.silver["order_items"]
    assert fact.count() == items.join(m.silver["orders"], "order_id", "left_semi").count()  # of known orders
    bad = fact.filter(F.col("is_late").isNotNull() & (F.col("is_late") != (F.col("delay_days") > 0))).count()
    assert bad == 0
    assert fact.filter(F.col("delivered_at") < F.col("purchased_at")).count() == 0
    assert fact.filter(F.col("delay_days").isNull() & F.col("is_late").isNotNull()).count() == 0
