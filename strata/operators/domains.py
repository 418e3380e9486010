"""Value domains of table columns, enforced.

A domain says which values a column may hold: a range, a set, a pattern or the
keys of another table, and whether it may be empty. ``domain_report`` compiles
the domains of each table into one counting pass (references count their keys
first, so no key is hot in the join with the parent), ``quarantine`` returns the
offending rows with the names of the domains they break. NULL breaks a domain
only where a value is required.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: at most this many lacking keys of a table are broadcast
BROADCAST_KEYS = 1 << 20
REPORT_COLUMNS = ["table", "column", "domain", "rows", "empty", "violations"]


@dataclass(frozen=True)
class Domain:
    """What a column may hold; without any part, everything."""
    low: float | None = None
    high: float | None = None
    above: bool = False                     # low itself is outside
    members: tuple[str, ...] | None = None
    pattern: str | None = None
    reference: tuple[str, str] | None = None  # table, column
    required: bool = False

    def needed(self) -> Domain:
        return replace(self, required=True)

    @property
    def text(self) -> str:
        parts = ["required"] if self.required else []
        if self.low is not None and self.high is not None:
            parts.append(f"{self.low:g} to {self.high:g}")
        elif self.low is not None:
            parts.append(f"{'above' if self.above else 'at least'} {self.low:g}")
        elif self.high is not None:
            parts.append(f"at most {self.high:g}")
        if self.members is not None:
            parts.append("one of " + ", ".join(self.members))
        if self.pattern is not None:
            parts.append(f"like {self.pattern}")
        if self.reference is not None:
            parts.append("key of " + ".".join(self.reference))
        return ", ".join(parts)

    def broken(self, column: str) -> Column:
        """Whether a row's own value breaks the domain (references apart)."""
        c, tests = F.col(column), []
        if self.low is not None:
            tests.append(c > self.low if self.above else c >= self.low)
        if self.high is not None:
            tests.append(c <= self.high)
        if self.members is not None:
            tests.append(c.isin(*self.members))
        if self.pattern is not None:
            tests.append(c.rlike(self.pattern))
        ok = F.lit(True)
        for t in tests:
            ok = ok & t
        return F.coalesce(~ok, F.lit(False)) | (c.isNull() if self.required else F.lit(False))


ANYTHING = Domain()


def at_least(low: float) -> Domain:
    return Domain(low=low)


def above(low: float) -> Domain:
    return Domain(low=low, above=True)


def between(low: float, high: float) -> Domain:
    return Domain(low=low, high=high)


def one_of(*members: str) -> Domain:
    return Domain(members=members)


def like(pattern: str) -> Domain:
    return Domain(pattern=pattern)


def key_of(table: str, column: str) -> Domain:
    return Domain(reference=(table, column))


Domains = Mapping[str, Domain]  # column -> domain


def _row(table: str, column: str, domain: Domain, rows: Column, empty: Column, violations: Column) -> Column:
    return F.struct(F.lit(table).alias("table"), F.lit(column).alias("column"), F.lit(domain.text).alias("domain"),
                    rows.cast("long").alias("rows"), empty.cast("long").alias("empty"),
                    violations.cast("long").alias("violations"))


def _own_values(df: DataFrame, table: str, domains: Domains) -> DataFrame:
    items = list(domains.items())
    exprs = [F.count(F.lit(1)).alias("__rows")]
    for i, (c, d) in enumerate(items):
        exprs += [F.count_if(F.col(c).isNull()).alias(f"__e{i}"), F.count_if(d.broken(c)).alias(f"__v{i}")]
    rows = [_row(table, c, d, F.col("__rows"), F.col(f"__e{i}"), F.col(f"__v{i}")) for i, (c, d) in enumerate(items)]
    return df.agg(*exprs).select(F.inline(F.array(*rows)))


def _references(df: DataFrame, table: str, column: str, domain: Domain, parent: DataFrame) -> DataFrame:
    """One counted row per key meets the parent's distinct keys."""
    per_key = df.groupBy(F.col(column).alias("__k")).agg(F.count(F.lit(1)).alias("__n"))
    keys = parent.select(F.col(domain.reference[1]).alias("__k"), F.lit(True).alias("__known")).distinct()
    n, null = F.col("__n"), F.col("__k").isNull()
    lost = F.when(null, F.lit(domain.required)).otherwise(F.col("__known").isNull())

    def total(test: Column) -> Column:
        return F.coalesce(F.sum(F.when(test, n)), F.lit(0))
    one = per_key.join(keys, "__k", "left").agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("__rows"), total(null).alias("__e"), total(lost).alias("__v"))
    return one.select(F.inline(F.array(_row(table, column, domain, F.col("__rows"), F.col("__e"), F.col("__v")))))


def broken_references(tables: Mapping[str, DataFrame], domains: Mapping[str, Domains]) -> DataFrame:
    """(table, column, key, rows): the keys that their parent lacks, as text,
    with the rows that hold them. Written, it saves ``domain_report`` and
    ``quarantine`` the joins with the parents."""
    out = None
    for table, of in domains.items():
        for c, d in of.items():
            if d.reference is not None:
                per_key = tables[table].where(F.col(c).isNotNull()).groupBy(F.col(c).alias("__k")).agg(
                    F.count(F.lit(1)).alias("rows"))
                keys = tables[d.reference[0]].select(F.col(d.reference[1]).alias("__k")).distinct()
                one = per_key.join(keys, "__k", "left_anti").select(
                    F.lit(table).alias("table"), F.lit(c).alias("column"), F.col("__k").cast("string").alias("key"), "rows")
                out = one if out is None else out.unionByName(one)
    return out


def _of_reference(broken: DataFrame, table: str, column: str) -> DataFrame:
    return broken.where((F.col("table") == table) & (F.col("column") == column))


def _counted_references(df: DataFrame, table: str, domains: Domains, broken: DataFrame) -> list[DataFrame]:
    """As ``_references``, from the broken ones: one pass counts the empty."""
    items = list(domains.items())
    one = df.agg(F.count(F.lit(1)).alias("__rows"),
                 *[F.count_if(F.col(c).isNull()).alias(f"__e{i}") for i, (c, _) in enumerate(items)])
    for i, (c, _) in enumerate(items):
        one = one.crossJoin(_of_reference(broken, table, c).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias(f"__v{i}")))
    rows = [_row(table, c, d, F.col("__rows"), F.col(f"__e{i}"),
                 F.col(f"__v{i}") + (F.col(f"__e{i}") if d.required else F.lit(0))) for i, (c, d) in enumerate(items)]
    return [one.select(F.inline(F.array(*rows)))]


def domain_report(tables: Mapping[str, DataFrame], domains: Mapping[str, Domains],
                  broken: DataFrame | None = None) -> DataFrame:
    """(table, column, domain, rows, empty, violations), a row a domain.
    ``broken`` are the ``broken_references``, where known."""
    out = None
    for table, of in domains.items():
        own = {c: d for c, d in of.items() if d.reference is None and d != ANYTHING}
        frames = [_own_values(tables[table], table, own)] if own else []
        keyed = {c: d for c, d in of.items() if d.reference is not None}
        if broken is not None and keyed:
            frames += _counted_references(tables[table], table, keyed, broken)
        else:
            frames += [_references(tables[table], table, c, d, tables[d.reference[0]]) for c, d in keyed.items()]
        for f in frames:
            out = f if out is None else out.unionByName(f)
    return out.select(*REPORT_COLUMNS)


def quarantine(df: DataFrame, domains: Domains, tables: Mapping[str, DataFrame],
               name: str = "_violations", broken: DataFrame | None = None, table: str | None = None) -> DataFrame:
    """The rows of ``df`` that break a domain, with the sorted columns that do
    in ``name``. A parent is reduced to distinct keys, so no row is doubled.
    With the ``broken_references`` the rows of ``table`` meet the lacking keys
    alone, broadcast up to ``BROADCAST_KEYS``; that counts them at once."""
    few = broken is not None and broken.where(F.col("table") == table).limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    breaks, joined = {}, df
    for i, (c, d) in enumerate(sorted(domains.items())):
        if d.reference is not None and broken is not None:
            lost = _of_reference(broken, table, c).select(F.col("key").alias(f"__key{i}"), F.lit(True).alias(f"__lost{i}"))
            lost = F.broadcast(lost) if few else lost
            joined = joined.join(lost, F.col(c).cast("string") == F.col(f"__key{i}"), "left")
            broke = F.when(F.col(c).isNull(), F.lit(d.required)).otherwise(F.col(f"__lost{i}").isNotNull())
        elif d.reference is not None:
            known = f"__known{i}"
            keys = tables[d.reference[0]].select(F.col(d.reference[1]).alias(f"__key{i}"), F.lit(True).alias(known)).distinct()
            joined = joined.join(keys, joined[c] == keys[f"__key{i}"], "left").drop(f"__key{i}")
            broke = F.when(F.col(c).isNull(), F.lit(d.required)).otherwise(F.col(known).isNull())
        elif d != ANYTHING:
            broke = d.broken(c)
        else:
            continue
        breaks[c] = broke
    if not breaks:
        return df.withColumn(name, F.array().cast("array<string>")).where(F.lit(False))
    # no test is NULL; only the rows that fail one get an array
    named = F.array_compact(F.array(*[F.when(broke, F.lit(c)) for c, broke in breaks.items()]))
    return joined.where(reduce(or_, breaks.values())).select(*df.columns, named.alias(name))


def with_members(domains: Mapping[str, Domains], columns: Sequence[tuple[str, str]],
                 members: Sequence[str]) -> dict[str, dict[str, Domain]]:
    """``domains`` where the given (table, column)s hold one of ``members``."""
    out = {t: dict(of) for t, of in domains.items()}
    for t, c in columns:
        out[t][c] = replace(out[t].get(c, ANYTHING), members=tuple(members))
    return out


__all__ = ["ANYTHING", "Domain", "above", "at_least", "between", "broken_references", "domain_report", "key_of", "like", "one_of", "quarantine",
           "with_members"]
