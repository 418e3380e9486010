from strata.session import scratch_path
from strata.sources.catalog import (apply_dictionary, create_schema, describe_dictionary, drop_schema, overwrite_table,
                                    sql_string, table_comment)


def test_dictionary_and_overwrite_keep_comments(spark):
    create_schema(spark, "strata_unit", "unit test layer")
    assert "strata_unit" in [d.name for d in spark.catalog.listDatabases()]
    df = spark.createDataFrame([(1, "a")], "id int, name string")
    loc = scratch_path(spark, "cat")
    overwrite_table(df.select("id"), "strata_unit.t", loc, "v1")
    overwrite_table(df, "strata_unit.t", loc, "it's v2")           # schema replaced, comment re-applied
    assert table_comment(spark, "strata_unit.t") == "it's v2"
    apply_dictionary(spark, "strata_unit", {"t": {"_table": "doc", "id": "Primary key. Lineage: x.id",
                                                 "name": "Name with 'quotes'"}})
    rows = describe_dictionary(spark, "strata_unit", ["t"]).collect()
    assert [(r.position, r.column, r.data_type, r.comment) for r in rows] == [
        (1, "id", "int", "Primary key. Lineage: x.id"), (2, "name", "string", "Name with 'quotes'")]
    assert table_comment(spark, "strata_unit.t") == "doc"


def test_sql_string():
    assert sql_string("it's") == "'it\\'s'"


def test_list_tables_and_catalog(spark):
    from strata.sources.catalog import list_tables, use_catalog
    create_schema(spark, "strata_unit2")
    overwrite_table(spark.range(3), "strata_unit2.x", scratch_path(spark, "cat2"))
    assert [r.tableName for r in list_tables(spark, "strata_unit2").collect()] == ["x"]
    use_catalog(spark, "spark_catalog")
    assert spark.catalog.currentCatalog() == "spark_catalog"


def test_materialize_cuts_lineage(spark, small_dir):
    from strata.plans.medallion import Medallion
    m = Medallion(spark, small_dir)
    out = m.materialize(scratch_path(spark, "mat"))
    assert "_silver_ts" in out.silver["orders"].columns
    assert out.gold["fact_order_items"].count() == m.gold["fact_order_items"].count()
    plan = out.gold["fact_order_items"]._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan          # reads the written table, not the dedup lineage


def test_materialize_with_landing_layer(spark, small_dir):
    from strata.plans.medallion import Medallion
    m = Medallion(spark, small_dir)
    out = m.materialize(scratch_path(spark, "mat-bronze"), bronze=True)
    plan = out.bronze["order_items"]._jdf.queryExecution().optimizedPlan().toString()
    assert "lineitem" not in plan                      # landing read back from its written copy
    assert out.silver["order_items"].count() == m.silver["order_items"].count()
    assert out.gold["fact_payments"].count() == m.gold["fact_payments"].count()


def test_failed_overwrite_leaves_the_table(spark):
    """A write that dies midway: the old rows, schema and comment stay, a
    later write succeeds and clears what the failed one left."""
    import pytest
    from pyspark.sql import functions as F

    from strata.sources.catalog import table_location, versions
    create_schema(spark, "strata_unit3")
    name, loc = "strata_unit3.t", scratch_path(spark, "cat3")
    old = spark.range(100).withColumn("v", F.lit("old"))
    overwrite_table(old, name, loc, "kept")
    first = table_location(spark, name)
    dies = spark.range(0, 1000, 1, 8).withColumn("v", F.when(F.col("id") == 900, F.raise_error(F.lit("killed"))).otherwise(F.lit("new")))
    with pytest.raises(Exception, match="killed"):
        overwrite_table(dies, name, loc, "never")
    assert table_location(spark, name) == first and table_comment(spark, name) == "kept"
    assert spark.table(name).groupBy("v").count().collect() == [("old", 100)]
    reader = spark.table(name)
    overwrite_table(spark.range(5).withColumn("v", F.lit("new")), name, loc, "next")   # same columns: a change of location
    assert reader.count() == 100                       # who had opened the old version reads on
    assert spark.table(name).count() == 5 and table_comment(spark, name) == "next"
    overwrite_table(spark.range(7).toDF("other"), name, loc)                           # other columns: a new entry
    assert spark.table(name).columns == ["other"] and spark.table(name).count() == 7
    assert len(versions(spark, loc)) == 2              # the current one and the one before


def test_schemas_are_listed(spark):
    from strata.sources.catalog import list_schemas
    create_schema(spark, "strata_unit4", "unit test layer")
    rows = {r.schema: r.comment for r in list_schemas(spark).collect()}
    assert rows["strata_unit4"] == "unit test layer" and "default" in rows


def test_overwrite_in_and_out_of_buckets(spark):
    from strata.sources.catalog import _layout
    name, loc = "strata_unit_buckets.t", scratch_path(spark, "cat-buckets")
    create_schema(spark, "strata_unit_buckets")
    df = spark.range(50).selectExpr("id", "id % 7 AS k", "cast(id AS string) AS s")
    try:
        for buckets in (3, 3, 5, None, 4):
            got = overwrite_table(df, name, loc, buckets=buckets, bucket_by=["k"])
            assert sorted(got.collect()) == sorted(df.collect())
            assert _layout(spark, name) == (f"CLUSTERED BY (`k`) SORTED BY (`k`) INTO {buckets} BUCKETS" if buckets else "")
        assert [r.tableName for r in spark.sql("SHOW TABLES IN strata_unit_buckets").collect()] == ["t"]
    finally:
        drop_schema(spark, "strata_unit_buckets")
