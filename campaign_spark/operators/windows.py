"""Window operators: running totals, value counts and top-k per column.

``running_totals`` does not put a whole partition group into one task. It
splits each group into blocks along its order (each date, optionally cut
further by ranges of the first tie-break): per-block totals are
pre-aggregated and turned into "total before this block" offsets by a window
over the small per-block table, and the running sum inside a block runs as a
window partitioned by the block. The result is the same as one window
ordered by (date, tie-breaks) over the whole group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campaign_spark.functions.nulls import drop_null_keys, na_label
from campaign_spark.operators.ordering import ranked


def _null_safe_on(left: DataFrame, right: DataFrame, keys: list[str], prefix: str) -> Column:
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(right[f"{prefix}{k}"])
        cond = c if cond is None else cond & c
    return cond


def running_totals(
    df: DataFrame,
    partition_by: list[str],
    order_by: str,
    measures: list[str],
    tiebreak: list[str] | None = None,
    suffix: str = "_cumul",
    sub_blocks: int | None = None,
) -> DataFrame:
    """Append ``{m}{suffix}``: running sum of ``m`` within each group.

    Semantics: rows are ordered by ``order_by`` ascending with NULLs last,
    then by ``tiebreak``; rows whose group key has a NULL part are dropped; a
    row whose own value is NULL gets a NULL running total and later rows
    continue from the total of the non-null values so far.

    Work split: a *block* is a contiguous run of the group's order. By
    default a block is one (group, date). With ``sub_blocks=k`` each
    (group, date) is further cut into ``k`` contiguous ranges of the first
    tie-break column (numeric), with boundaries from a ``percentile_approx``
    sketch per (group, date), so a single hot date of a hot group is spread
    over ``k`` tasks too. Offsets ("total before this block") come from a
    window over the small per-block table; the running sum inside a block is
    a window partitioned by the block.
    """
    tiebreak = tiebreak or []
    src = drop_null_keys(df, partition_by)
    day_keys = [*partition_by, order_by]
    block_keys = list(day_keys)
    block_order = [F.col(order_by).asc_nulls_last()]
    if sub_blocks and sub_blocks > 1 and tiebreak:
        first = tiebreak[0]
        cuts = F.array(*[F.lit(i / sub_blocks) for i in range(1, sub_blocks)])
        bounds = src.groupBy(*day_keys).agg(F.percentile_approx(first, cuts, 1000).alias("_tb")).select(
            *[F.col(k).alias(f"__b_{k}") for k in day_keys], "_tb")
        t = F.col(first)
        src = (
            src.join(bounds, _null_safe_on(src, bounds, day_keys, "__b_"), "left")
            .withColumn("__blk", F.when(t.isNull(), F.lit(sub_blocks))
                        .otherwise(F.size(F.filter("_tb", lambda b: b < t))))
            .drop("_tb", *[f"__b_{k}" for k in day_keys])
        )
        block_keys.append("__blk")
        block_order.append(F.col("__blk").asc())

    per_block = src.groupBy(*block_keys).agg(*[F.sum(m).alias(f"__day_{m}") for m in measures])
    before = Window.partitionBy(*partition_by).orderBy(*block_order).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_block.select(
        *[F.col(k).alias(f"__k_{k}") for k in block_keys],
        *[F.sum(f"__day_{m}").over(before).alias(f"__before_{m}") for m in measures],
    )
    within = Window.partitionBy(*block_keys).orderBy(*[F.col(t).asc_nulls_last() for t in tiebreak]).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    # Within-block running sums first (one shuffle of the rows by block),
    # then the per-block offsets are joined on; that table has one row per
    # block, so AQE broadcasts it whenever its measured size allows.
    ran = src.withColumns({f"__run_{m}": F.sum(m).over(within) for m in measures})
    joined = ran.join(offsets, _null_safe_on(ran, offsets, block_keys, "__k_"), "left")
    outs = {
        f"{m}{suffix}": F.when(
            F.col(m).isNotNull(),
            F.coalesce(F.col(f"__before_{m}"), F.lit(0)) + F.col(f"__run_{m}"),
        )
        for m in measures
    }
    return joined.withColumns(outs).select(*df.columns, *outs.keys())


def value_counts(df: DataFrame, cols: list[str], k: int | None = None) -> DataFrame:
    """Counts of every value of every column, one job for all columns.

    Output: ``column``, ``value`` (string, NULL shown as ``'NA'``),
    ``n_counts``, ``rank`` (1 = most frequent; ties by value). With ``k`` only
    the first ``k`` per column are kept; Spark then runs a per-partition
    top-k before the shuffle (WindowGroupLimit).
    """
    items = F.array(*[F.struct(F.lit(c).alias("column"), na_label(c).alias("value")) for c in cols])
    long = df.select(F.explode(items).alias("_v")).select("_v.column", "_v.value")
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n_counts"))
    return rank_within(counts, ["column"], k)


def distinct_value_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """Number of distinct values of each column (NULL counted once, as
    'NA'), all columns in one job: ``column``, ``n_distinct``. Computed from
    the same (column, value) histogram as ``value_counts``."""
    items = F.array(*[F.struct(F.lit(c).alias("column"), na_label(c).alias("value")) for c in cols])
    long = df.select(F.explode(items).alias("_v")).select("_v.column", "_v.value")
    hist = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("_n"))
    return hist.groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct"))


def value_counts_within(
    df: DataFrame, by: str, col: str, k: int | None = None, drop_null_by: bool = True,
) -> DataFrame:
    """Histogram of ``col`` inside each value of ``by`` (``col`` NULL -> 'NA').

    Output: ``by``, ``col``, ``n_counts``, ``rank``. Rows with a NULL ``by``
    are dropped unless ``drop_null_by`` is False.
    """
    src = drop_null_keys(df, [by]) if drop_null_by else df
    counts = (
        src.groupBy(by, F.col(col).alias("_v"))
        .agg(F.count(F.lit(1)).alias("n_counts"))
        # A stored 'NA' and NULL are one label.
        .groupBy(by, na_label("_v").alias(col))
        .agg(F.sum("n_counts").alias("n_counts"))
    )
    return rank_within(counts, [by], k, value_col=col)


def rank_within(counts: DataFrame, part: list[str], k: int | None, value_col: str = "value") -> DataFrame:
    """``rank`` by count descending, then value, inside each ``part`` group.

    With ``k``: ``row_number() <= k``, which Spark runs as a partial top-k
    per task before the shuffle. Without ``k`` (full ranking) the rows are
    range-partitioned on the group, the count and the value itself, and ranks
    come from prefix sums over the ranges (``ordering.ranked``): neither a
    group with very many distinct values nor a long run of equal counts, with
    whatever common start, is one task.
    """
    if k is not None:
        w = Window.partitionBy(*part).orderBy(F.desc("n_counts"), F.asc(value_col))
        return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return ranked(counts, part, [F.desc("n_counts"), value_col])


def simple_value_counts(df: DataFrame, col: str | Column, name: str) -> DataFrame:
    """Histogram of one expression: ``name``, ``n_counts`` (NULL kept as NULL)."""
    c = F.col(col) if isinstance(col, str) else col
    return df.groupBy(c.alias(name)).agg(F.count(F.lit(1)).alias("n_counts"))
