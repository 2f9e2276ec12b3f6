"""Yes/no text flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import labels


def yes_flag(c: Column, yes: str = labels.YES) -> Column:
    """Exactly ``yes`` -> true; "no", NULL and anything else -> false.
    Never NULL (the warehouse column is NOT NULL)."""
    return F.coalesce(c == F.lit(yes), F.lit(False))
