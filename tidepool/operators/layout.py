"""Partition layout helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin the rows over at least ``min_partitions`` (default: the
    cluster's parallelism) before CPU-heavy per-row work (Arrow UDFs).

    A no-op when the input already has that many partitions, which is the
    case for any large table (many files / row groups): the extra shuffle is
    only paid by inputs too small to keep every core busy, such as a single
    small file or one micro-batch file.
    """
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= want:
        return df
    return df.repartition(want)
