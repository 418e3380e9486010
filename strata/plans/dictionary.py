"""Data dictionary of the gold layer, drawn up from the specifications: what a
column means, which values it may hold, how it is read and where it comes from."""

from __future__ import annotations

from ..operators.domains import ANYTHING, Domain
from .specs import CALENDAR, CALENDAR_DOMAINS, GOLD, READ_AS, SILVER, Derived


def _origin(column: str, tables: tuple[str, ...]) -> str:
    """Where a silver column comes from and how it is read there."""
    for t in tables:
        for f in SILVER[t].fields:
            if f.name == column:
                return f"bronze.{t}.{f.header} > silver.{t}.{column} ({READ_AS[f.kind]})"
    raise KeyError(column)


def _comment(field: Derived, tables: tuple[str, ...]) -> str:
    how = "" if field.how == "same" else f" Derived in gold: {field.how}."
    return f"{_about(field.about, field.domain)}{how} From {'; '.join(_origin(c, tables) for c in field.of)}."


def _about(about: str, domain: Domain) -> str:
    holds = f" Domain: {domain.text}." if domain != ANYTHING else ""
    return f"{about[0].upper()}{about[1:]}.{holds}"


def gold_dictionary() -> dict[str, dict[str, str]]:
    """{table: {column, or _table for the table itself: comment}}"""
    out = {}
    for table, (row, tables, fields) in GOLD.items():
        out[table] = {"_table": f"One row for {row}. From silver.{', silver.'.join(tables)}."}
        out[table] |= {f.name: _comment(f, tables) for f in fields}
    out["dim_date"] = {"_table": "One row for a day between the first and the last purchase. From silver.orders."}
    out["dim_date"] |= {c: _about(about, CALENDAR_DOMAINS.get(c, ANYTHING)) for c, about in CALENDAR.items()}
    return out


GOLD_DICTIONARY = gold_dictionary()
