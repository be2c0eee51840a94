"""Business domain and environment read off object names.

``_`` is a one-character wildcard in LIKE, so ``FIN_%`` also matches ``FINANCE_WH``.
Matching is case-sensitive and a NULL name falls through to the last arm.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Name patterns and the domain each stands for, first match wins.
WAREHOUSE_DOMAINS = (
    ("FIN_%", "FINANCE"),
    ("MKT_%", "MARKETING"),
    ("ECO_%", "ECOMMERCE"),
    ("RET_%", "RETAIL"),
    ("ANA_%", "ANALYTICS"),
    ("LOY_%", "LOYALTY"),
    ("MGMT_%", "MANAGEMENT"),
    ("TRANSFORM_%", "DATA_ENG"),
)
DATABASE_DOMAINS = (
    ("FIN%", "FINANCE"),
    ("MKT%", "MARKETING"),
    ("MARKET%", "MARKETING"),
    ("ECO%", "ECOMMERCE"),
    ("RET%", "RETAIL"),
    ("ANA%", "ANALYTICS"),
    ("LOY%", "LOYALTY"),
    ("MGMT%", "MANAGEMENT"),
)
EXTRA_WAREHOUSE_DOMAINS = (("SAL_%", "SALES"), ("HR_%", "HR"))
EXTRA_DATABASE_DOMAINS = (("SAL%", "SALES"), ("HR%", "HR"), ("TRANSFORM%", "DATA_ENG"))
DOMAIN_NAMES = (
    "FINANCE",
    "MARKETING",
    "ECOMMERCE",
    "RETAIL",
    "ANALYTICS",
    "LOYALTY",
    "MANAGEMENT",
    "DATA_ENG",
    "OTHER",
)
ENVIRONMENTS = ("PROD", "UAT", "DEV")


def _first_match(name: Column, patterns: tuple[tuple[str, str], ...], default: str) -> Column:
    ladder = F
    for pattern, label in patterns:
        ladder = ladder.when(name.like(pattern), F.lit(label))
    return ladder.otherwise(F.lit(default))


def domain_from_warehouse(name: Column, extended: bool = False) -> Column:
    """``extended`` adds the sales and HR warehouses, which otherwise map to OTHER."""
    extra = EXTRA_WAREHOUSE_DOMAINS if extended else ()
    return _first_match(name, WAREHOUSE_DOMAINS + extra, "OTHER")


def domain_from_database(name: Column, extended: bool = False) -> Column:
    extra = EXTRA_DATABASE_DOMAINS if extended else ()
    return _first_match(name, DATABASE_DOMAINS + extra, "OTHER")


def environment_from_name(name: Column) -> Column:
    """Environment marker in the name; a name without one (``FIN_WH``) counts as DEV."""
    marked = F
    for marker in ENVIRONMENTS:
        marked = marked.when(name.contains(marker), F.lit(marker))
    return marked.otherwise(F.lit("DEV"))
