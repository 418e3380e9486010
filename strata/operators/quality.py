"""Declarative data-quality rules and their compiler.

A rule names a dimension (uniqueness, completeness, ...), a table, a
human-readable check, the kind of measurement and the treatment applied
downstream. ``run_rules`` compiles a rule list into few Spark plans:

* all row-predicate rules of one table become one aggregation pass
  (``count_if`` per rule), not one job per rule;
* key, reference and outlier rules get their own small plan;
* the results are combined with ``unionByName`` into one DataFrame with
  one row per rule. Nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.aggregates import count_where
from ..functions.columns import to_double
from .quantiles import quantile_stats

RESULT_COLUMNS = ["dimension", "table", "check", "occurrences", "treatment"]


@dataclass
class Rule:
    dimension: str
    table: str
    check: str
    kind: str                      # predicate | surplus | duplicate_keys | missing_reference | iqr_upper
    treatment: str = ""
    predicate: Column | Callable[[], Column] | None = None
    keys: tuple[str, ...] = ()
    null_safe: bool = False
    column: str | None = None
    ref_table: str | None = None
    ref_column: str | None = None
    fence: float = 1.5


def predicate_rule(dimension, table, check, predicate: Column | Callable[[], Column], treatment="") -> Rule:
    return Rule(dimension, table, check, "predicate", treatment, predicate=predicate)


def surplus_rule(dimension, table, check, keys: Sequence[str], treatment="", null_safe=False) -> Rule:
    return Rule(dimension, table, check, "surplus", treatment, keys=tuple(keys), null_safe=null_safe)


def duplicate_keys_rule(dimension, table, check, keys: Sequence[str], treatment="") -> Rule:
    return Rule(dimension, table, check, "duplicate_keys", treatment, keys=tuple(keys))


def missing_reference_rule(dimension, table, check, column, ref_table, ref_column, treatment="") -> Rule:
    return Rule(dimension, table, check, "missing_reference", treatment, column=column,
                ref_table=ref_table, ref_column=ref_column)


def iqr_rule(dimension, table, check, column, treatment="", fence=1.5) -> Rule:
    return Rule(dimension, table, check, "iqr_upper", treatment, column=column, fence=fence)


# ---------------------------------------------------------------- measurements

def _per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys..., __n, __whole): rows per key tuple and whether no part is
    NULL. One partial and one final hash aggregate."""
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).withColumn("__whole", whole)


def duplicate_surplus(df: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """One row: rows, distinct key tuples, surplus = rows - distinct.

    SQL semantics by default: tuples with a NULL part are not counted as
    distinct values, so they all count as surplus. ``null_safe`` counts
    each distinct tuple, NULLs included, once."""
    distinct = F.count(F.lit(1)) if null_safe else F.count_if("__whole")
    return _per_key(df, keys).agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("long").alias("rows"),
                                  distinct.alias("distinct_keys")) \
                             .withColumn("surplus", F.col("rows") - F.col("distinct_keys"))


def duplicate_surplus_modes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Two rows (null_safe false / true) of ``duplicate_surplus`` from one
    scan and one shuffle: both distinct counts follow from the rows per key."""
    one = _per_key(df, keys).agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("long").alias("rows"),
                                 F.count_if("__whole").alias("__sql"), F.count(F.lit(1)).alias("__safe"))
    modes = F.array(F.struct(F.lit(False).alias("null_safe"), F.col("__sql").alias("distinct_keys")),
                    F.struct(F.lit(True).alias("null_safe"), F.col("__safe").alias("distinct_keys")))
    return one.select("rows", F.inline(modes)).withColumn("surplus", F.col("rows") - F.col("distinct_keys"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: number of keys that occur more than once. The per-key count
    is a partial + final hash aggregate, so a hot key costs one counter per
    map partition."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.count_if(F.col("n") > 1).alias("keys_with_duplicates"))


def missing_reference(df: DataFrame, column: str, ref: DataFrame, ref_column: str) -> DataFrame:
    """One row: distinct non-NULL values of ``column`` without a match in
    ``ref``. Both sides are reduced to distinct values before the anti
    join."""
    values = df.select(F.col(column).alias("__v")).filter(F.col("__v").isNotNull()).distinct()
    known = ref.select(F.col(ref_column).alias("__v")).filter(F.col("__v").isNotNull()).distinct()
    return values.join(known, "__v", "left_anti").agg(F.count(F.lit(1)).alias("missing"))


def _fences(df: DataFrame, columns: Mapping[str, Column], fences: Mapping[str, float]) -> DataFrame:
    """One row with a struct (q1, q3, upper_fence) per named column; all
    quartiles come from one pass over the data."""
    stats = quantile_stats(df, columns, [0.25, 0.75])
    out = []
    for n in columns:
        q1, q3 = F.col(f"{n}__q0"), F.col(f"{n}__q1")
        out.append(F.struct(q1.alias("q1"), q3.alias("q3"),
                            (q3 + F.lit(fences[n]) * (q3 - q1)).alias("upper_fence")).alias(n))
    return stats.select(*out)


def _as_double(column: str) -> Column:
    return to_double(F.col(column).cast("string"))


def iqr_fence(df: DataFrame, column: str, fence: float = 1.5) -> DataFrame:
    """One row: q1, q3 and the upper fence q3 + fence * (q3 - q1) of a
    column read tolerantly as double (exact lower quartiles)."""
    return _fences(df, {"__v": _as_double(column)}, {"__v": fence}).select("__v.*")


def iqr_outliers(df: DataFrame, column: str, fence: float = 1.5) -> DataFrame:
    """One row: q1, q3, fence and the number of rows strictly above it."""
    return iqr_report(df, [column], fence).drop("column")


def iqr_report(df: DataFrame, columns: Sequence[str], fence: float = 1.5) -> DataFrame:
    """(column, q1, q3, upper_fence, outliers) for several columns of one
    table: one pass for every quartile (returned as one struct subquery,
    evaluated once) and one pass counting the rows above each fence."""
    vals = {f"__c{i}": _as_double(c) for i, c in enumerate(columns)}
    st = _fences(df, vals, dict.fromkeys(vals, fence)).select(F.struct(*vals)).scalar()
    flags = df.select(*[(vals[n] > st[n]["upper_fence"]).alias(n) for n in vals])
    counts = flags.agg(*[count_where(F.col(n)).alias(n) for n in vals])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), st[n]["q1"].alias("q1"), st[n]["q3"].alias("q3"),
                              st[n]["upper_fence"].alias("upper_fence"), F.col(n).alias("outliers"))
                     for n, c in zip(vals, columns)])
    return counts.select(F.inline(rows))


# ---------------------------------------------------------------- compiler

def _meta(rule: Rule, occurrences: Column) -> Column:
    return F.struct(F.lit(rule.dimension).alias("dimension"), F.lit(rule.table).alias("table"),
                    F.lit(rule.check).alias("check"), occurrences.cast("long").alias("occurrences"),
                    F.lit(rule.treatment).alias("treatment"))


def _reference_rule(rule: Rule, tables: Mapping[str, DataFrame]) -> DataFrame:
    res = missing_reference(tables[rule.table], rule.column, tables[rule.ref_table], rule.ref_column)
    return res.select(F.inline(F.array(_meta(rule, F.col("missing")))))


_PASS_KINDS = ("predicate", "iqr_upper")


def _table_pass(df: DataFrame, rules: Sequence[Rule]) -> list[DataFrame]:
    """All predicate rules of one table in one aggregation pass; IQR rules add
    a pass for the quartiles of every IQR column and one that counts rows above
    the fences, which are one scalar subquery."""
    plain = [(i, r) for i, r in enumerate(rules) if r.kind == "predicate"]
    iqr = [(i, r) for i, r in enumerate(rules) if r.kind == "iqr_upper"]
    out = []
    if plain:
        exprs = [count_where(r.predicate if isinstance(r.predicate, Column) else r.predicate()).alias(f"__r{i}")
                 for i, r in plain]
        out.append(df.agg(*exprs).select(F.inline(F.array(*[_meta(r, F.col(f"__r{i}")) for i, r in plain]))))
    if iqr:
        vals = {f"__q{i}": _as_double(r.column) for i, r in iqr}
        st = _fences(df, vals, {f"__q{i}": r.fence for i, r in iqr}).select(F.struct(*vals)).scalar()
        flags = [(vals[n] > st[n]["upper_fence"]).alias(n) for n in vals]
        above = df.select(*flags).agg(*[count_where(F.col(n)).alias(n) for n in vals])
        out.append(above.select(F.inline(F.array(*[_meta(r, F.col(f"__q{i}")) for i, r in iqr]))))
    return out


def _key_pass(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Surplus and duplicate-key rules over the same keys of one table, from
    one count of the rows per key."""
    measures = {"duplicate_keys": F.count_if(F.col("__n") > 1),
                "surplus": F.coalesce(F.sum("__n"), F.lit(0)) - F.count_if("__whole"),
                "surplus_safe": F.coalesce(F.sum("__n"), F.lit(0)) - F.count(F.lit(1))}
    which = [r.kind + "_safe" * (r.kind == "surplus" and r.null_safe) for r in rules]
    one = _per_key(df, rules[0].keys).agg(*[measures[w].alias(w) for w in dict.fromkeys(which)])
    return one.select(F.inline(F.array(*[_meta(r, F.col(w)) for r, w in zip(rules, which)])))


def run_rules(tables: Mapping[str, DataFrame], rules: Sequence[Rule]) -> DataFrame:
    """Evaluate ``rules`` -> (dimension, table, check, occurrences, treatment).

    Predicates and IQR fences of one table share passes, key rules share one
    count per key tuple, reference rules get their own small plan."""
    frames: list[DataFrame] = []
    by_table: dict[str, list[Rule]] = {}
    by_key: dict[tuple, list[Rule]] = {}
    for r in rules:
        if r.kind in _PASS_KINDS:
            by_table.setdefault(r.table, []).append(r)
        elif r.kind in ("surplus", "duplicate_keys"):
            by_key.setdefault((r.table, r.keys), []).append(r)
        elif r.kind == "missing_reference":
            frames.append(_reference_rule(r, tables))
        else:
            raise ValueError(f"unknown rule kind {r.kind!r}")
    for table, rs in by_table.items():
        frames.extend(_table_pass(tables[table], rs))
    frames += [_key_pass(tables[table], rs) for (table, _), rs in by_key.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.select(*RESULT_COLUMNS)


__all__ = ["Rule", "duplicate_keys", "duplicate_keys_rule", "duplicate_surplus", "duplicate_surplus_modes", "iqr_fence",
           "iqr_outliers", "iqr_report", "iqr_rule", "missing_reference", "missing_reference_rule", "predicate_rule",
           "run_rules", "surplus_rule"]
