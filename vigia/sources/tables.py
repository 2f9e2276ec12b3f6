"""Access to the benchmark tables (one parquet file or folder per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ensure_parallel(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread a scan over the cluster's cores when it has fewer input splits
    than cores (a single-row-group file reads as one task).  Decided at plan
    time from the split count; a large multi-file input already has many more
    splits than cores and is returned unchanged (no shuffle)."""
    n = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(n) if df.rdd.getNumPartitions() < n else df


def fact_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A large table, spread over the cores when it arrives as too few splits."""
    return ensure_parallel(table(spark, sf_dir, name))
