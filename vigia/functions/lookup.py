"""Small fixed dictionaries as Column expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def lookup(c: Column, mapping: dict, default=None) -> Column:
    """``mapping[c]`` with ``default`` for unknown keys or NULL.  Built as a
    literal map inside the plan: no join, no broadcast, stays in codegen."""
    m = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))
    looked = F.try_element_at(m, c)
    return looked if default is None else F.coalesce(looked, F.lit(default))
