"""Catalogue: layer schemas, table sinks with comments, a data dictionary
(column comments carrying description, domain and lineage) and its
listing."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..session import PARQUET

TABLE_KEY = "_table"


def sql_string(text: str) -> str:
    """Quote ``text`` as a SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_schema(spark: SparkSession, name: str, comment: str | None = None, location: str | None = None) -> None:
    stmt = f"CREATE SCHEMA IF NOT EXISTS {name}"
    if comment:
        stmt += f" COMMENT {sql_string(comment)}"
    if location:
        stmt += f" LOCATION {sql_string(location)}"
    spark.sql(stmt)


def drop_schema(spark: SparkSession, name: str) -> None:
    """Remove a schema, its location and the entries of its tables; files of
    tables written to a path outside that location stay."""
    spark.sql(f"DROP SCHEMA IF EXISTS {name} CASCADE")


def comment_table(spark: SparkSession, table: str, comment: str) -> None:
    spark.sql(f"COMMENT ON TABLE {table} IS {sql_string(comment)}")


def _files(spark: SparkSession, path: str):
    """(file system, path) of the store that holds ``path``."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def table_location(spark: SparkSession, table: str) -> str | None:
    """Where the files of ``table`` are, None if there is no such table."""
    if not spark.catalog.tableExists(table):
        return None
    for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect():
        if r["col_name"] == "Location":
            return r["data_type"]
    return None


def versions(spark: SparkSession, path: str) -> list[str]:
    """The version folders below ``path``, oldest first."""
    fs, root = _files(spark, path)
    if not fs.exists(root):
        return []
    found = [s for s in fs.listStatus(root) if s.isDirectory() and s.getPath().getName().startswith(_VERSION)]
    return [s.getPath().toString() for s in sorted(found, key=lambda s: (s.getModificationTime(), s.getPath().getName()))]


def _default_path(spark: SparkSession, table: str) -> str:
    name = table.split(".")
    schema = name[-2] if len(name) > 1 else spark.catalog.currentDatabase()
    return f"{spark.catalog.getDatabase(schema).locationUri.rstrip('/')}/{name[-1]}"


def overwrite_table(df: DataFrame, table: str, path: str | None = None, comment: str | None = None,
                    keep: int = 1, buckets: int | None = None, bucket_by: Sequence[str] = ()) -> DataFrame:
    """Replace ``table``, its schema included, all at once.

    The rows go to a fresh version folder below ``path`` (the table's place in
    its schema where not given); only when all are written does the catalogue
    entry change over to it. A write that fails, or a job that is killed, leaves
    the table as it was, and who reads the old version reads on: the ``keep``
    versions before the new one stay, older ones and those that failed writes
    left behind go. An entry with the same columns changes its location in one
    step; for other columns the entry is made anew, which moves no data, and
    the old one is restored if that fails.

    With ``buckets`` the rows are dealt over that many buckets by ``bucket_by``,
    and the entry says so: joins and groupings by these columns need no shuffle.
    Rows that are already partitioned so make one file a bucket."""
    spark = df.sparkSession
    path = (path or _default_path(spark, table)).rstrip("/")
    new = f"{path}/{_VERSION}{uuid.uuid4().hex}"
    if buckets:
        staging = f"{table}_{uuid.uuid4().hex}"  # only a table can be written in buckets; its files stay
        df.write.format("parquet").options(**PARQUET).option("path", new).bucketBy(buckets, *bucket_by).sortBy(
            *bucket_by).saveAsTable(staging)
        spark.sql(f"DROP TABLE {staging}")
    else:
        df.write.mode("error").options(**PARQUET).parquet(new)
    old = table_location(spark, table)
    columns = [(f.name, f.dataType.simpleString()) for f in df.schema]
    same = old is not None and [(c.name, c.dataType) for c in spark.catalog.listColumns(table)] == columns
    layout = _layout(spark, table) if old is not None else ""
    wanted = _bucket_clause(buckets, bucket_by) if buckets else ""
    if same and _versioned(old) and layout == wanted:
        spark.sql(f"ALTER TABLE {table} SET LOCATION {sql_string(new)}")
    else:
        _point(spark, table, old, new, columns, layout, wanted)
    if comment:
        comment_table(spark, table, comment)
    _drop_old(spark, path, [x for x in (old, new) if x], keep)
    return spark.table(table)


_VERSION = "version-"


def _bucket_clause(buckets: int, by: Sequence[str]) -> str:
    names = ", ".join(f"`{c}`" for c in by)
    return f"CLUSTERED BY ({names}) SORTED BY ({names}) INTO {buckets} BUCKETS"


def _layout(spark: SparkSession, table: str) -> str:
    """How the rows of ``table`` are dealt over buckets, as a clause."""
    told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    if not told.get("Num Buckets"):
        return ""
    by = [c.strip().strip("`") for c in told["Bucket Columns"].strip("[]").split(",")]
    return _bucket_clause(int(told["Num Buckets"]), by)


def _versioned(location: str) -> bool:
    return location.rstrip("/").rsplit("/", 1)[-1].startswith(_VERSION)


def _entry(spark: SparkSession, table: str, columns: Sequence[tuple[str, str]], layout: str, place: str) -> None:
    # only an entry in buckets needs its columns named
    named = "(" + ", ".join(f"`{c}` {t}" for c, t in columns) + ") " if layout else ""
    spark.sql(f"CREATE TABLE {table} {named}USING parquet {layout} LOCATION {sql_string(place)}")


def _point(spark: SparkSession, table: str, old: str | None, new: str, columns: Sequence[tuple[str, str]] = (),
           layout: str = "", wanted: str = "") -> None:
    """Make the catalogue entry of ``table`` anew, for the files at ``new``, in
    the buckets ``wanted``; those of the old files are in ``layout``."""
    before = [(c.name, c.dataType) for c in spark.catalog.listColumns(table)] if old is not None and layout else []
    if old is not None:
        # a table that this function didn't write owns its files: they would go with its entry
        kept = old if _versioned(old) else None
        if kept is None:
            external = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Type' AND data_type = 'EXTERNAL'")
            kept = old if not external.isEmpty() else None
        spark.sql(f"DROP TABLE {table}")
    try:
        _entry(spark, table, columns, wanted, new)
    except Exception:
        if old is not None and kept is not None:
            _entry(spark, table, before, layout, kept)
        raise


def _drop_old(spark: SparkSession, path: str, named: list[str], keep: int) -> None:
    """Remove version folders but the current one and ``keep`` before it."""
    def tail(x: str) -> str:
        return x.rstrip("/").rsplit("/", 1)[-1]
    current = tail(named[-1])
    before = [v for v in versions(spark, path) if tail(v) != current]
    # the version read until now is the last to go
    before.sort(key=lambda v: tail(v) in {tail(x) for x in named})
    for v in before[:max(0, len(before) - keep)]:
        fs, where = _files(spark, v)
        fs.delete(where, True)


def apply_dictionary(spark: SparkSession, schema: str, spec: Mapping[str, Mapping[str, str]]) -> None:
    """Set table comments (key ``_table``) and column comments from
    ``spec``: {table: {column or '_table': text}}."""
    for table, doc in spec.items():
        name = f"{schema}.{table}"
        if TABLE_KEY in doc:
            comment_table(spark, name, doc[TABLE_KEY])
        for column, text in doc.items():
            if column != TABLE_KEY:
                spark.sql(f"ALTER TABLE {name} ALTER COLUMN {column} COMMENT {sql_string(text)}")


def describe_dictionary(spark: SparkSession, schema: str, tables: list[str] | None = None) -> DataFrame:
    """(table, position, column, data_type, comment) for the tables of
    ``schema``: catalogue metadata only, one row per column."""
    names = tables or [t.name for t in spark.catalog.listTables(schema)]
    rows = []
    for t in sorted(names):
        for pos, c in enumerate(spark.catalog.listColumns(f"{schema}.{t}")):
            rows.append((t, pos + 1, c.name, c.dataType, c.description))
    return spark.createDataFrame(rows, "table string, position int, column string, data_type string, comment string")


def table_comment(spark: SparkSession, table: str) -> str | None:
    for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect():
        if r["col_name"] == "Comment":
            return r["data_type"]
    return None


def list_schemas(spark: SparkSession) -> DataFrame:
    """(schema, comment, location) of the current catalogue's schemas."""
    rows = [(d.name, d.description, d.locationUri) for d in spark.catalog.listDatabases()]
    return spark.createDataFrame(sorted(rows), "schema string, comment string, location string")


def list_tables(spark: SparkSession, schema: str) -> DataFrame:
    """Tables of ``schema`` (SHOW TABLES)."""
    return spark.sql(f"SHOW TABLES IN {schema}")


def use_catalog(spark: SparkSession, name: str) -> None:
    """Make ``name`` the current catalogue (the session catalogue is
    ``spark_catalog``)."""
    spark.catalog.setCurrentCatalog(name)
