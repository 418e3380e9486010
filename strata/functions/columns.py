"""Column builders: pure Column -> Column expressions.

Everything here is a built-in Spark expression, so it stays inside
whole-stage codegen and is evaluated on the executors. No Python UDFs.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- text

def clean_text(c: ColumnOrName) -> Column:
    """Trim spaces; an empty result becomes NULL."""
    return F.nullif(F.trim(_c(c)), F.lit(""))


def lower_text(c: ColumnOrName) -> Column:
    return F.lower(clean_text(c))


def upper_text(c: ColumnOrName) -> Column:
    return F.upper(clean_text(c))


def pad_code(c: ColumnOrName, width: int = 5, fill: str = "0") -> Column:
    """Left-pad a cleaned code (e.g. a zip prefix) to a fixed width.
    Longer values are cut to ``width`` (``lpad`` semantics)."""
    return F.lpad(clean_text(c), width, fill)


def is_blank(c: ColumnOrName) -> Column:
    """NULL or only spaces."""
    col = _c(c)
    return col.isNull() | (F.trim(col) == "")


def clean_header(name: str) -> str:
    """Column-name hygiene for text sources: drop the byte-order mark and
    surrounding blanks."""
    return name.replace("\ufeff", "").strip()


# ---------------------------------------------------------------- tolerant typing

def to_timestamp(c: ColumnOrName) -> Column:
    """Text -> naive timestamp; unparsable text becomes NULL."""
    return _c(c).try_cast("timestamp_ntz")


def to_decimal(c: ColumnOrName, precision: int = 12, scale: int = 2) -> Column:
    """Text -> decimal, rounded half-up to ``scale``; overflow becomes NULL."""
    return _c(c).try_cast(f"decimal({precision},{scale})")


def to_double(c: ColumnOrName) -> Column:
    return _c(c).try_cast("double")


def to_int(c: ColumnOrName) -> Column:
    """Text -> int through double, so '40.0' parses; fractions truncate
    toward zero, NaN and out-of-range values become NULL."""
    return _c(c).try_cast("double").try_cast("int")


# ---------------------------------------------------------------- value repair

def default_if_null(c: ColumnOrName, value) -> Column:
    return F.coalesce(_c(c), F.lit(value))


def fallback(c: ColumnOrName, other: ColumnOrName) -> Column:
    return F.coalesce(_c(c), _c(other))


def null_nonpositive(c: ColumnOrName) -> Column:
    """Keep positive values, NULL otherwise."""
    col = _c(c)
    return F.when(col > 0, col)


def clamp_min(c: ColumnOrName, minimum) -> Column:
    """Raise values below ``minimum`` to it; NULL stays NULL."""
    col = _c(c)
    return F.when(col < minimum, F.lit(minimum)).otherwise(col)


def null_if_before(c: ColumnOrName, start: ColumnOrName) -> Column:
    """NULL out ``c`` when it lies before ``start`` (inconsistent order)."""
    col = _c(c)
    return F.when(col < _c(start), F.lit(None)).otherwise(col)


# ---------------------------------------------------------------- lookups and dates

def map_lookup(c: ColumnOrName, mapping: Mapping[str, str]) -> Column:
    """Constant-map lookup; unknown keys and NULL give NULL. The literal map
    is folded by Catalyst, so no join or broadcast is needed."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.try_element_at(m, _c(c))


def date_key(c: ColumnOrName) -> Column:
    """Surrogate day key yyyyMMdd as int, by arithmetic for the years 1 to 9999."""
    day, year = F.to_date(_c(c)), F.year(_c(c))
    return F.when(year.between(1, 9999), year * 10000 + F.month(day) * 100 + F.dayofmonth(day)) \
            .otherwise(F.date_format(_c(c), "yyyyMMdd").cast("int"))


def days_between(end: ColumnOrName, start: ColumnOrName) -> Column:
    """Calendar days from ``start`` to ``end`` (dates of the timestamps)."""
    return F.datediff(F.to_date(_c(end)), F.to_date(_c(start)))


def late_flag(delay_days: ColumnOrName) -> Column:
    """Three-valued: NULL when the delay is unknown, else delay > 0."""
    return _c(delay_days) > 0


# ---------------------------------------------------------------- banding

def bucketize(c: ColumnOrName, bounds: Sequence[tuple[object, str]], else_label: str,
              inclusive: bool = True, null_to_else: bool = False) -> Column:
    """Label ``c`` by the first upper bound it does not exceed.

    ``bounds`` is an ordered list of (upper_bound, label); ``inclusive``
    chooses ``<=`` or ``<``. NULL input gives NULL, or ``else_label`` when
    ``null_to_else`` is set (the behaviour of a plain searched CASE)."""
    col = _c(c)
    expr = None
    for upper, label in bounds:
        cond = (col <= upper) if inclusive else (col < upper)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    if null_to_else:
        return expr.otherwise(F.lit(else_label))
    return F.when(col.isNull(), F.lit(None).cast("string")).otherwise(expr.otherwise(F.lit(else_label)))


def round_half_up(c: ColumnOrName, digits: int) -> Column:
    """Round a double half-up on its decimal representation and return a
    double. Goes through DECIMAL so the result does not depend on the
    binary expansion of the value."""
    return F.round(_c(c).try_cast("decimal(38,9)"), digits).cast("double")


def all_of(conds: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds)
