"""The medallion pipeline over one data directory: landing (bronze) ->
silver -> gold, as lazily built DataFrames.

Nothing runs until a report or a write asks for it; Catalyst then sees
the whole chain from the parquet scans to the report and prunes columns
and pushes filters through every layer. ``materialize`` writes the
silver and gold tables to a shared folder and continues from the written
copies - the lineage cut a long pipeline needs so that a lost executor
only recomputes from the last written layer.
"""

from __future__ import annotations

import os
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import setting, written
from ..sources.landing import LANDING_TABLES, landing_table, state_region_map
from ..sources.tables import TableSet
from . import gold as G
from . import silver as S

SILVER_TABLES = ("customers", "sellers", "orders", "order_items", "order_payments", "order_reviews",
                 "category_translation", "products")
AUDIT_COLUMN = "_silver_ts"
#: landed rows of the largest table in a bucket: some 50 MB in a task
BUCKET_ROWS = 1 << 18
GOLD_TABLES = ("dim_customer", "dim_seller", "dim_product", "dim_date", "fact_order_items", "fact_payments")


def buckets_for(bronze: Mapping[str, DataFrame], bucket_rows: int = BUCKET_ROWS) -> int:
    """Over how many buckets by order the tables of orders are dealt."""
    rows = max(bronze[t].count() for t in ("order_items", "order_payments", "order_reviews"))
    return -(-max(rows, 1) // bucket_rows)


class LazyFrames(Mapping):
    """name -> DataFrame, each built on first access only, so a report
    that needs two tables does not pay for analysing all of them."""

    def __init__(self, factories: dict):
        self._factories = factories
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._factories[name]()
        return self._built[name]

    def __iter__(self):
        return iter(self._factories)

    def __len__(self):
        return len(self._factories)


class Medallion:
    """``bronze``, ``silver`` or ``gold`` frames may be given; layers that are
    not are derived, the landing layer from the tables of ``data_dir``.
    ``spread_hot`` salts orders with a large share of the items (see ``gold``);
    ``buckets`` deals the silver tables of orders over partitions by order."""

    def __init__(self, spark: SparkSession, data_dir: str | None = None, region_map=None,
                 bronze: Mapping | None = None, silver: Mapping | None = None, gold: Mapping | None = None,
                 spread_hot: bool = False, buckets: int | None = None):
        self.spark = spark
        self.spread_hot = spread_hot
        self.buckets = buckets
        self.tables = TableSet(spark, data_dir) if data_dir else None
        self.region_map = region_map if region_map is not None else state_region_map()
        self.bronze: Mapping[str, DataFrame] = bronze if bronze is not None else LazyFrames(
            {name: (lambda n=name: landing_table(spark, self.tables, n)) for name in LANDING_TABLES})
        self.silver: Mapping[str, DataFrame] = silver if silver is not None else self._silver()
        self.gold: Mapping[str, DataFrame] = gold if gold is not None else self._gold()

    def _silver(self) -> LazyFrames:
        s: LazyFrames = LazyFrames({t: (lambda t=t: S.build(t, self.bronze, s, self.buckets)) for t in SILVER_TABLES})
        return s

    def _gold(self) -> LazyFrames:
        return LazyFrames({t: (lambda t=t: G.build(t, self.silver, self.region_map, self.spread_hot)) for t in GOLD_TABLES})

    def materialize(self, path: str, audit: bool = True, parallel: int = 4,
                    bronze: bool = False) -> "Medallion":
        """Write the layers as parquet under ``path`` (a shared folder), each
        built from the written copy of the layer before it: landing
        (bronze, with ``bronze``), silver, gold. Return a pipeline reading
        the written tables, so each layer's lineage starts at its files and
        a lost executor recomputes from the last written layer only.

        Tables of one layer do not depend on each other, so their write
        jobs are submitted concurrently (``parallel`` driver threads) and
        share the cluster. With ``audit`` the silver tables carry the
        ``_silver_ts`` load timestamp."""
        landed = self.bronze
        if bronze:
            landed = self._write_layer(path, "bronze", {n: landed[n] for n in LANDING_TABLES}, False, parallel)
        source = Medallion(self.spark, region_map=self.region_map, bronze=landed) if bronze else self
        silver = self._write_layer(path, "silver", {n: source.silver[n] for n in SILVER_TABLES}, audit, parallel)
        staged = Medallion(self.spark, region_map=self.region_map, bronze=landed, spread_hot=self.spread_hot,
                           silver={n: df.drop(AUDIT_COLUMN) for n, df in silver.items()})
        gold = self._write_layer(path, "gold", {n: staged.gold[n] for n in GOLD_TABLES}, False, parallel)
        out = Medallion(self.spark, region_map=self.region_map, bronze=landed, silver=silver, gold=gold)
        out.tables = self.tables
        return out

    def _write_layer(self, path: str, layer: str, frames: dict, audit: bool, parallel: int) -> dict:
        def write(item):
            name, df = item
            loc = os.path.join(path, layer, name)
            if audit:
                df = df.withColumn(AUDIT_COLUMN, F.current_timestamp())
            df.write.mode("overwrite").parquet(loc)
            return name, loc

        with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
            written = dict(pool.map(write, frames.items()))
        return {name: self.spark.read.parquet(written[name]) for name in frames}


def checked_gold(m: Medallion, columns: Mapping[str, list[str]]) -> dict[str, DataFrame]:
    """The given columns of the gold tables of ``m``, written one after the
    other: the shuffles of one are gone before the next, each table of orders
    is dealt by order once, and what follows reads files."""
    buckets = buckets_for(m.bronze)
    dealt = Medallion(m.spark, region_map=m.region_map, bronze=m.bronze, buckets=buckets)
    with setting(m.spark, "spark.sql.shuffle.partitions", str(buckets)):
        silver = {t: dealt.silver[t] for t in SILVER_TABLES} | {"orders": written(dealt.silver["orders"], "silver-orders")}
        gold = Medallion(m.spark, region_map=m.region_map, bronze=m.bronze, silver=silver, spread_hot=m.spread_hot).gold
        facts_first = sorted(columns, key=lambda t: not t.startswith("fact_"))  # little is written when most is shuffled
        return {t: written(gold[t].select(*columns[t]), f"gold-{t}") for t in facts_first}
