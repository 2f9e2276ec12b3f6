"""Number formatting used in report headers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def thousands_dot(c: Column) -> Column:
    """1234567 -> '1.234.567' (whole number, '.' as thousands separator)."""
    return F.translate(F.format_number(c.cast("double"), 0), ",", ".")


def two_decimals(c: Column) -> Column:
    """12.345 -> '12.35' (no thousands separator)."""
    return F.format_string("%.2f", c.cast("double"))
