"""String, masking and semi-structured helpers."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from usagelens.functions.temporal import timestamp_text

PII_ROLE = "PAYROLL_PII"


def regexp_first(text: Column, pattern: str, group: int = 1) -> Column:
    """First case-insensitive match of ``group``, NULL when there is none."""
    return F.nullif(F.regexp_extract(text, f"(?i){pattern}", group), F.lit(""))


def name_part(qualified: Column, position: int) -> Column:
    """1-based part of a dotted name, ``''`` when missing."""
    return F.split_part(qualified, F.lit("."), F.lit(position))


def surrogate_key(name: Column, ts: Column) -> Column:
    return F.md5(F.concat(name, timestamp_text(ts)))


def blank_to(text: Column, default: str) -> Column:
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(default))


def user_names(comma_list: Column) -> Column:
    """Array of upper-cased, trimmed, non-empty names from a comma-separated list."""
    names = F.transform(F.split(F.upper(comma_list), ","), lambda name: F.trim(name))
    return F.filter(names, lambda name: name != "")


def mask_email(email: Column, roles: Iterable[str]) -> Column:
    """Clear text for a session holding the PII role, ``j***@host`` for others."""
    if PII_ROLE in set(roles):
        return email
    return F.regexp_replace(email, "(^.).*(@.*$)", "$1***$2")


def variant_path(value: Column, path: str, data_type: str) -> Column:
    """Typed value at ``a:b`` style ``path`` of a variant column."""
    return F.variant_get(value, "$." + path.replace(":", "."), data_type)


def parse_json(text: Column) -> Column:
    return F.parse_json(text)


def constant_rows(names: Sequence[str], rows: Iterable[Sequence[str | int]]) -> Column:
    """Constant array of structs, stated as one expression rather than a call per value."""

    def literal(value: str | int) -> str:
        if isinstance(value, int):
            return f"{value}L"
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

    structs = (
        ", ".join(f"'{name}', {literal(value)}" for name, value in zip(names, row)) for row in rows
    )
    return F.expr(f"array({', '.join(f'named_struct({body})' for body in structs)})")


# In-row array operations: run these before exploding, so less data is multiplied.

def keep(items: Column, condition: Callable[[Column], Column]) -> Column:
    return F.filter(items, condition)


def any_match(items: Column, condition: Callable[[Column], Column]) -> Column:
    return F.exists(items, condition)


def all_match(items: Column, condition: Callable[[Column], Column]) -> Column:
    return F.forall(items, condition)


def total(items: Column) -> Column:
    return F.aggregate(items, F.lit(0).cast("long"), lambda acc, item: acc + item)
