"""Row filters and keys (F1-F7).  Each predicate maps columns to a boolean Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# endings of static resources (fixed values)
STATIC_ENDINGS = ["css", "js", "png", "ico"]


def is_page_view(column: str = "behavior") -> Column:
    """``pv`` rows; null drops."""
    return F.col(column) == "pv"


def is_get(column: str = "method") -> Column:
    """GET requests."""
    return F.col(column) == "GET"


def is_page(column: str = "url") -> Column:
    """urls that do not end in a static resource."""
    return ~F.col(column).rlike(r"\.(" + "|".join(STATIC_ENDINGS) + r")$")


def is_installed(column: str = "behavior") -> Column:
    """everything but ``UNINSTALL``; a null behaviour is kept."""
    return ~F.col(column).eqNullSafe("UNINSTALL")


def has_transaction(column: str = "tx_id") -> Column:
    """everything but the empty transaction id; null is kept."""
    return ~F.col(column).eqNullSafe("")


def constant_key(label: str, name: str) -> Column:
    """one label for all rows, for results that carry a fixed key."""
    return F.lit(label).alias(name)


def salt(*columns: str, salts: int = 10) -> Column:
    """a salt 0..salts-1 from a hash of the row, the same on every retry."""
    return F.pmod(F.xxhash64(*columns), F.lit(salts)).cast("int")
