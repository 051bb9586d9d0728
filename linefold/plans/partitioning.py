"""Parallelism of the fixture: its tables are single files."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """``df``, round-robin repartitioned only if it has fewer partitions than cores.

    A scan of one unsplittable file (one parquet row group, one gzip file)
    is a single task, however many cores the cluster has; everything fused
    into that stage (rendering, parsing, partial aggregation) then runs on one
    core. When the scan already has at least ``min_partitions`` splits
    (default: the cluster's default parallelism), as any large input does,
    this returns ``df`` unchanged and adds no shuffle.
    """
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(want) if df.rdd.getNumPartitions() < want else df
