"""The five view frames kept for the charts of one dashboard run.

The source dashboard caches each view's rows for ten minutes.  Here a run
persists the five view results (aggregates, much smaller than the facts)
so several chart-level aggregates read them once, and releases them at the
end of the run.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from . import views as V


@contextmanager
def dashboard_views(t: dict[str, DataFrame], level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Yield ``{view name: persisted DataFrame}``; unpersist on exit."""
    frames = {name: fn(t).persist(level) for name, fn in V.VIEWS.items()}
    try:
        yield frames
    finally:
        for df in frames.values():
            df.unpersist()
