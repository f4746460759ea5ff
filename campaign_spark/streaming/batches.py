"""Batched result fetch (a cursor that yields ``batch_size`` rows at a time)."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row


def batched_rows(df: DataFrame, batch_size: int = 1000) -> Iterator[list[Row]]:
    """Yield lists of at most ``batch_size`` rows.

    Uses ``toLocalIterator(prefetchPartitions=True)``: partitions are computed
    by the executors and streamed one at a time, so the driver's memory is
    bounded by one partition plus one batch. Any task failure is raised, never
    turned into a silently shortened result.
    """
    if batch_size <= 0:
        raise ValueError("batch_size must be positive")
    batch: list[Row] = []
    for row in df.toLocalIterator(prefetchPartitions=True):
        batch.append(row)
        if len(batch) == batch_size:
            yield batch
            batch = []
    if batch:
        yield batch
