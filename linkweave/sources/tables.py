"""Table scans.

``read_table`` selects only the needed columns (so the parquet scan's
``ReadSchema`` is pruned) and, when a scan yields fewer partitions than the
session has cores (a file with one row group cannot be split), spreads the rows
round-robin so that per-row work (regexes, array functions, HTML parsing) runs
on every core.  On a cluster reading many splits the scan already has enough
partitions and no shuffle is added.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def parallelism(spark: SparkSession) -> int:
    return max(int(spark.sparkContext.defaultParallelism), 1)


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin repartition only when ``df`` has too few partitions."""
    target = min_partitions or parallelism(df.sparkSession)
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df


def read_table(
    spark: SparkSession,
    sf_dir: str,
    name: str,
    columns: Sequence[str] | None = None,
    spread_rows: bool = False,
) -> DataFrame:
    """``{sf_dir}/{name}.parquet`` with only ``columns`` read."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if columns:
        df = df.select(*columns)
    return spread(df) if spread_rows else df
