import os

from pyspark.sql import functions as F

from strata.session import scratch_path
from strata.sources.csv_text import missing_files, read_text_csv, row_counts, source_name, write_text_csv

CSV = ('﻿customer_id, city ,note\n'
       '1,"Sao\nPaulo","say ""hi"""\n'
       '2,,""\n'
       '3,"  ",x\n')


def test_csv_text_first(spark):
    path = scratch_path(spark, "csv-unit")
    os.makedirs(path)
    with open(os.path.join(path, "customers.csv"), "w", encoding="utf-8") as f:
        f.write(CSV)
    df = read_text_csv(spark, path)
    assert df.columns == ["customer_id", "city", "note", "_source_file", "_ingestion_ts"]
    assert all(t == "string" for _, t in df.dtypes[:3])
    rows = {r.customer_id: r for r in df.collect()}
    assert len(rows) == 3                               # quoted newline stays in one record
    assert rows["1"].city == "Sao\nPaulo" and rows["1"].note == 'say "hi"'
    assert rows["2"].city is None and rows["2"].note is None    # empty and "" -> NULL
    assert rows["3"].city == "  "                                # blanks kept for the cleaning layer
    assert rows["1"]._source_file.endswith("customers.csv")


def test_write_read_roundtrip_keeps_blanks(spark):
    df = spark.createDataFrame([(" a ", None), ("  ", "x")], "a string, b string")
    path = scratch_path(spark, "csv-rt")
    write_text_csv(df, path)
    back = read_text_csv(spark, path).select("a", "b").collect()
    assert sorted((r.a, r.b) for r in back) == sorted([(" a ", None), ("  ", "x")])


def test_manifest_and_provenance(spark, small_dir):
    missing = missing_files(spark, small_dir, ["orders.parquet", "nope.parquet"]).collect()
    assert [r.file_name for r in missing] == ["nope.parquet"]
    folders = scratch_path(spark, "folders")
    spark.range(3).write.parquet(os.path.join(folders, "part.parquet"))
    assert missing_files(spark, folders, ["part.parquet"]).count() == 0
    root = scratch_path(spark, "prov")
    df = spark.range(10).select(F.col("id").cast("string").alias("id"))
    write_text_csv(df, os.path.join(root, "tbl"), files=2)
    got = read_text_csv(spark, os.path.join(root, "tbl")).groupBy(source_name().alias("s")).count().collect()
    assert [(r.s, r["count"]) for r in got] == [("tbl", 10)]
    rc = row_counts({"x": df, "y": df.limit(3)}).collect()
    assert sorted((r.table, r.rows) for r in rc) == [("x", 10), ("y", 3)]


def test_ingest_all_manifest_load(spark):
    from strata.sources.csv_text import ingest_all
    landing = scratch_path(spark, "landing")
    os.makedirs(landing)
    with open(os.path.join(landing, "a.csv"), "w", encoding="utf-8") as f:
        f.write("id,name\n1,x\n2,y\n")
    with open(os.path.join(landing, "b.csv"), "w", encoding="utf-8") as f:
        f.write("﻿k\n9\n")
    summary = ingest_all(spark, landing, {"ta": "a.csv", "tb": "b.csv"}, scratch_path(spark, "bronze"))
    assert sorted((r.table, r.rows, r.source) for r in summary.collect()) == [("ta", 2, "a.csv"), ("tb", 1, "b.csv")]


def test_swapped_header_fails(spark):
    """Files of one table whose headers differ must not land swapped."""
    import pytest

    from strata.streaming.ingest import ingest_available
    landing = scratch_path(spark, "swapped")
    os.makedirs(landing)
    for name, text in (("a.csv", "id,name\n1,ann\n"), ("b.csv", "name,id\nbob,2\n")):
        with open(os.path.join(landing, name), "w", encoding="utf-8") as f:
            f.write(text)
    with pytest.raises(Exception, match="[ab].csv"):
        read_text_csv(spark, landing).collect()
    with pytest.raises(Exception, match="[ab].csv"):
        ingest_available(spark, landing, scratch_path(spark, "sw-t"), scratch_path(spark, "sw-c"), columns=["id", "name"])


def test_written_csv_is_compressed(spark):
    path = scratch_path(spark, "csv-gz")
    df = spark.range(20_000).selectExpr("concat('order ', id) AS a", "concat('two', chr(10), 'lines') AS b")
    write_text_csv(df, path, files=1)
    parts = [os.path.join(path, f) for f in os.listdir(path) if f.startswith("part")]
    assert sum(map(os.path.getsize, parts)) * 3 < 20_000 * 25
    assert read_text_csv(spark, path).select("a", "b").exceptAll(df).count() == 0


def test_landing_files_are_gzipped_quickly(spark, tmp_path):
    import glob
    import gzip
    import zlib

    df = spark.range(20_000).selectExpr("concat('name ', id * 7919 % 9973) AS a", "cast(id as string) AS b")
    write_text_csv(df.coalesce(1), str(tmp_path / "t.csv"))
    packed = open(glob.glob(str(tmp_path / "t.csv/part-*.gz"))[0], "rb").read()
    raw = gzip.decompress(packed)
    quick, usual = (len(zlib.compress(raw, level)) for level in (4, 6))
    assert raw.count(b"\n") == 20_001 and quick > usual and abs(len(packed) - quick) < abs(len(packed) - usual)
