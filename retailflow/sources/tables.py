"""Reading the driver's parquet tables with explicit projections."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def spread(df: DataFrame, key=None, parallelism: int | None = None) -> DataFrame:
    """Hash-repartition a scan that has fewer splits than the cluster has
    cores (e.g. one file with one row group), so the per-row work that follows
    runs on every core. Hashing on a key keeps the layout deterministic if a
    task is retried. Scans that already have enough splits — any large input
    on a cluster — are returned unchanged, so no shuffle is added there.
    ``key`` may be one column or several; a row-unique key spreads evenly
    even when one business key holds a large share of the rows."""
    spark = df.sparkSession
    target = parallelism or spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    if not key:
        return df.repartition(target)
    keys = [key] if isinstance(key, str) else list(key)
    return df.repartition(target, *[F.col(k) for k in keys])


def read_table(spark: SparkSession, sf_dir: str, name: str,
               cols: Sequence[str] | None = None, spread_by=None) -> DataFrame:
    """Parquet scan of one table; ``cols`` become the scan's ReadSchema.

    ``spread_by`` names a key to spread an under-split scan on (see ``spread``).
    """
    df = spark.read.parquet(table_path(sf_dir, name))
    df = df.select(*cols) if cols else df
    return spread(df, spread_by) if spread_by else df
