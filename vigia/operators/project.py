"""Projection, renaming and row filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import labels


def project_existing(df: DataFrame, wanted: list[str]) -> DataFrame:
    """Select the wanted columns that exist, in wish-list order (plan-time)."""
    present = set(df.columns)
    return df.select(*[c for c in wanted if c in present])


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename by dict; names absent from ``df`` are ignored."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def drop_null_rows(df: DataFrame, subset: list[str]) -> DataFrame:
    return df.dropna(subset=subset)


def drop_columns(df: DataFrame, names: list[str] = labels.DROPPED_COLUMNS) -> DataFrame:
    """Drop listed columns; absent ones are ignored."""
    return df.drop(*names)


def optional_filter(df: DataFrame, **equals) -> DataFrame:
    """Equality filters applied only when the value is set (not None and not
    the "all" sentinel) **and** the column exists.  The predicates are plain
    Column expressions, so Catalyst pushes them below aggregates and into the
    scan."""
    preds: list[Column] = [
        F.col(name) == F.lit(value)
        for name, value in equals.items()
        if value is not None and value != labels.ALL and name in df.columns
    ]
    return df if not preds else df.filter(reduce(lambda a, b: a & b, preds))


def with_constant(df: DataFrame, name: str, value, only_if_missing: bool = True) -> DataFrame:
    """Add a literal column (by default only when it is not there yet)."""
    if only_if_missing and name in df.columns:
        return df
    return df.withColumn(name, F.lit(value))
