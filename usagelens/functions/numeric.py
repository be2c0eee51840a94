"""Unit conversion, ratios and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KIB = 1024.0


def round_half_up(value: Column, places: int) -> Column:
    """Half-away-from-zero rounding on the decimal reading of a double."""
    return F.round(value.cast("decimal(38,10)"), places).cast("double")


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double, NULL when ``whole`` is zero."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def percentage(part: Column, whole: Column, places: int = 2) -> Column:
    return round_half_up(ratio(part, whole) * 100, places)


def bytes_to(unit: str, value: Column) -> Column:
    power = {"kb": 1, "mb": 2, "gb": 3}[unit]
    return value / F.lit(KIB**power)


def millis_to_seconds(value: Column) -> Column:
    return value / F.lit(1000)


def count_where(condition: Column) -> Column:
    """Conditional count that is 0, not NULL, when nothing matches."""
    return F.sum(F.when(condition, F.lit(1)).otherwise(F.lit(0)))


def to_whole(value: Column) -> Column:
    """Rounding cast to a whole number; a bare cast would cut the fraction off."""
    return F.round(value.cast("double"), 0).cast("long")
