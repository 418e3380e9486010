import os

from pyspark.sql import functions as F

from strata.session import scratch_path
from strata.sources.csv_text import write_text_csv
from strata.streaming import ingest_available


def test_incremental_ingest_is_exactly_once(spark):
    root = scratch_path(spark, "stream-unit")
    landing, table, ckpt = (os.path.join(root, p) for p in ("landing", "table", "ckpt"))
    df = spark.range(100).select(F.col("id").cast("string").alias("id"), F.lit(" x ").alias("v"))
    write_text_csv(df.filter("id < 40"), os.path.join(landing, "a"), files=2)
    ingest_available(spark, landing, table, ckpt, columns=["id", "v"])
    assert spark.read.parquet(table).count() == 40
    # a rerun with no new files adds nothing; new files are picked up once
    ingest_available(spark, landing, table, ckpt, columns=["id", "v"])
    write_text_csv(df.filter("id >= 40"), os.path.join(landing, "b"), files=3)
    ingest_available(spark, landing, table, ckpt, columns=["id", "v"])
    out = spark.read.parquet(table)
    assert out.count() == 100 and out.select("id").distinct().count() == 100
    assert out.filter(F.col("v") != " x ").count() == 0
    assert "_source_file" in out.columns
