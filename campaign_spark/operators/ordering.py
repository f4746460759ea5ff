"""Order across tasks: a frame range-partitioned on its whole sort key, written once, and ranks from prefix sums.

``in_order`` sorts a frame by ranges of the full key, so a group that holds most
rows, or a long run of equal leading columns, is spread over as many tasks as
its rows need. Every row gets its ``BLOCK`` (number of the range) and ``AT``
(place inside it); both are written with the rows, so all that is made from them
sees the same ranges: one source of boundaries, however often Spark re-plans or
retries.

``ranked`` needs no window over rows: the rows of a (group, block) are
neighbours, so their rank is what the group has in earlier blocks (a window over
one row per group and block) plus the distance to the first of them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campaign_spark.session import scratch_path

BLOCK, AT = "__block", "__at"
_PLACES = 33  # bits of a place within its task, as monotonically_increasing_id lays them out


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the shared folder and read back: its readers see one result, and a lost
    executor restarts from the files."""
    path = scratch_path(df.sparkSession, "ordered", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_order(df: DataFrame, order_by: list[str | Column], name: str, partitions: int | None = None) -> DataFrame:
    """``df`` with ``BLOCK`` and ``AT``, written in the order of ``order_by`` under the shared folder and read back.

    ``partitions`` fixes the number of ranges; by default it is the session's
    number of shuffle partitions, which AQE merges when they are small.
    """
    ranges = (df.repartitionByRange(partitions, *order_by) if partitions else df.repartitionByRange(*order_by))
    place = F.monotonically_increasing_id()
    out = ranges.sortWithinPartitions(*order_by).withColumn(AT, place)
    out = out.withColumn(BLOCK, F.shiftright(AT, _PLACES)).withColumn(AT, F.col(AT).bitwiseAND(F.lit((1 << _PLACES) - 1)))
    return written(out, name)


def _same(left: DataFrame, right: DataFrame, keys: list[str], prefix: str) -> Column:
    cond = left[BLOCK] == right[f"{prefix}{BLOCK}"]
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[f"{prefix}{k}"])
    return cond


def with_before(ordered: DataFrame, part: list[str], weight: Column | None = None) -> DataFrame:
    """Each row of ``in_order`` output with its group's ``__before`` (rows, or the sum of ``weight``, in
    earlier blocks), ``__all`` (in every block), ``__block_n`` (in its own block) and ``__first`` (the first place there)."""
    weight = F.lit(1) if weight is None else weight
    blocks = ordered.groupBy(*part, BLOCK).agg(F.sum(weight).alias("__block_n"), F.min(AT).alias("__first"))
    upto = Window.partitionBy(*part).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    blocks = blocks.select(
        *[F.col(k).alias(f"__k_{k}") for k in [*part, BLOCK]], "__block_n", "__first",
        (F.sum("__block_n").over(upto) - F.col("__block_n")).alias("__before"),
        F.sum("__block_n").over(Window.partitionBy(*part)).alias("__all"))
    return ordered.join(blocks, _same(ordered, blocks, part, "__k_"), "inner").select(
        *ordered.columns, "__before", "__all", "__block_n", "__first")


def ranked(df: DataFrame, part: list[str], order_by: list[str | Column], name: str = "rank",
           partitions: int | None = None) -> DataFrame:
    """``df`` with ``name``: 1, 2, ... along ``order_by`` inside each group of ``part`` (NULL is a group too).

    ``order_by`` must tell the rows of a group apart; rows that it can't tell
    apart get different ranks in any order.
    """
    placed = with_before(in_order(df, [*part, *order_by], "rank", partitions), part)
    rank = (F.col("__before") + F.col(AT) - F.col("__first") + 1).cast("long")
    return placed.select(*df.columns, rank.alias(name))
