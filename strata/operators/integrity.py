"""Post-load integrity checks: key uniqueness, orphans, row conservation.

Each check returns a DataFrame with one row per check
(table, check, violations, severity); ``enforce`` is the only action and
fails the run when an error-severity check has violations.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import all_of

REPORT_COLUMNS = ["table", "check", "violations", "severity"]


class IntegrityError(AssertionError):
    pass


def _check(counted: DataFrame, table: str, check: str, severity: str) -> DataFrame:
    return counted.select(F.lit(table).alias("table"), F.lit(check).alias("check"),
                          F.coalesce("violations", F.lit(0)).cast("long").alias("violations"),
                          F.lit(severity).alias("severity"))


def check_unique(df: DataFrame, keys: Sequence[str], table: str, severity: str = "error") -> DataFrame:
    """Rows beyond the first per key tuple (NULL keys form one group, as in
    ``dropDuplicates``), from one count of the rows per key."""
    keys = list(keys)
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    return _check(per_key.agg(F.sum(F.col("__n") - 1).alias("violations")), table, "unique " + ",".join(keys), severity)


def check_orphans(child: DataFrame, parent: DataFrame, key: str, table: str, parent_table: str,
                  severity: str = "warn") -> DataFrame:
    """Child rows whose ``key`` has no parent row (NULL keys are orphans).
    The child is reduced to one counted row per key, the parent to distinct
    keys; one anti join of these is left, in which no key is hot."""
    per_key = child.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    lost = per_key.join(parent.select(key).distinct(), key, "left_anti")
    return _check(lost.agg(F.sum("__n").alias("violations")), table, f"rows without match in {parent_table} ({key})",
                  severity)


def integrity_report(checks: Sequence[DataFrame]) -> DataFrame:
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out.select(*REPORT_COLUMNS)


def enforce(report: DataFrame) -> None:
    """Raise when any error-severity check has violations. The report has
    one row per check, so only the failing rows (few) reach the driver."""
    bad = report.filter((F.col("severity") == "error") & (F.col("violations") > 0)).collect()
    if bad:
        raise IntegrityError("; ".join(f"{r['table']}: {r['violations']} violations of {r['check']}" for r in bad))


def row_conservation(before: DataFrame, after: DataFrame, keys: Sequence[str], never_null: Sequence[str] = ()) -> DataFrame:
    """Compare two tables that must hold the same key multiset.

    One row: rows_before, rows_after, missing (key occurrences lost) and
    extra (key occurrences gained). Counting alone would let one lost row
    and one fanned-out row cancel out; comparing per-key counts does not.
    Each side is pre-aggregated per key before the full join, which is null-safe
    but for the keys ``never_null``: tables in buckets of these need no shuffle."""
    keys = list(keys)
    b = before.groupBy(*keys).agg(F.count(F.lit(1)).alias("__nb"))
    a = after.groupBy(*[F.col(k).alias(f"__a_{k}") for k in keys]).agg(F.count(F.lit(1)).alias("__na"))
    cond = all_of([F.col(k) == F.col(f"__a_{k}") if k in never_null else F.col(k).eqNullSafe(F.col(f"__a_{k}")) for k in keys])
    j = b.join(a, cond, "full_outer")
    nb, na = F.coalesce(F.col("__nb"), F.lit(0)), F.coalesce(F.col("__na"), F.lit(0))
    return j.agg(F.sum(nb).cast("long").alias("rows_before"), F.sum(na).cast("long").alias("rows_after"),
                 F.sum(F.greatest(nb - na, F.lit(0))).cast("long").alias("missing"),
                 F.sum(F.greatest(na - nb, F.lit(0))).cast("long").alias("extra"))
