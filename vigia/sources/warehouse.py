"""Warehouse sinks and readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def append_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Append rows to a parquet table (no index column is ever written)."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def load_ordered(tables: list[tuple[str, DataFrame]], root: str) -> dict[str, str]:
    """Load tables in the given order (dimensions before facts); the first
    failure raises and stops the rest.  Returns name -> path."""
    paths = {}
    for name, df in tables:
        path = f"{root.rstrip('/')}/{name}"
        df.write.mode("overwrite").parquet(path)
        paths[name] = path
    return paths


def view_scan(spark: SparkSession, name: str) -> DataFrame:
    """Read a registered table or view whole; errors propagate."""
    return spark.table(name)
