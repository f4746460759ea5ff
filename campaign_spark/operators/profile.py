"""Data-quality profiles: distribution summaries, code compliance, per-group
value histograms rendered as text, distinct counts and null-coverage gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campaign_spark.functions.nulls import drop_null_keys, na_label
from campaign_spark.fixed import CODE_PARTS, CODE_SEPARATOR, COUNT_ITEM_SEPARATOR as ITEM_SEPARATOR
from campaign_spark.functions.text import code_compliance_label, count_text
from campaign_spark.operators.quantiles import quantiles_long
from campaign_spark.operators.windows import rank_within

# Types whose values have labels of their own, none of them 'NA': counts by value are counts by label.
_ONE_LABEL_EACH = {T.DateType(), T.LongType(), T.IntegerType(), T.ShortType(), T.ByteType()}


def numeric_profile(df: DataFrame, cols: list[str], digits: int | None = None) -> DataFrame:
    """Describe each numeric column: one row per column with ``count``,
    ``mean``, ``std`` (sample), ``min``, ``p25``, ``p50``, ``p75``, ``max`` and
    ``n_null``. Quartiles are exact and linearly interpolated. ``mean`` and
    ``std`` are rounded only if ``digits`` is given.

    Moments come from one global aggregate over stacked columns (two-phase,
    one row per task per column shuffled); quartiles from the histogram plan.
    """
    items = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols
    ])
    long = df.select(F.explode(items).alias("_v")).select("_v.column", "_v.value")
    clean = F.when(~F.isnan("value"), F.col("value"))
    shown = (lambda c: c) if digits is None else (lambda c: F.round(c, digits))
    moments = long.groupBy("column").agg(
        F.count(clean).alias("count"),
        shown(F.avg(clean)).alias("mean"),
        shown(F.stddev_samp(clean)).alias("std"),
        F.min(clean).alias("min"),
        F.max(clean).alias("max"),
        F.count_if(F.col("value").isNull() | F.isnan("value")).alias("n_null"),
    )
    quart = (
        quantiles_long(df, [], cols, [0.25, 0.5, 0.75])
        .select(F.col("measure").alias("column"), F.col("q0").alias("p25"),
                F.col("q1").alias("p50"), F.col("q2").alias("p75"))
    )
    # One row per profiled column on each side: a size bound fixed by the
    # argument list, so the broadcast is safe at any data volume.
    return moments.join(F.broadcast(quart), "column", "left").select(
        "column", "count", "mean", "std", "min", "p25", "p50", "p75", "max", "n_null"
    )


def code_compliance(df: DataFrame, col: str, sep: str = CODE_SEPARATOR, parts: int = CODE_PARTS) -> DataFrame:
    """Count codes by compliance: ``'compliant'`` when the code has exactly
    ``parts`` ``sep``-separated pieces, else the code itself. NULL codes are
    left out. Output: ``code_label``, ``n_counts``."""
    return (
        df.where(F.col(col).isNotNull())
        .groupBy(code_compliance_label(col, sep, parts).alias("code_label"))
        .agg(F.count(F.lit(1)).alias("n_counts"))
    )


def group_value_histogram(
    df: DataFrame, keys: list[str], col: str, text_col: str | None = None, count_col: str | None = None,
    chunk_size: int | None = None,
) -> DataFrame:
    """Per group: the distinct count of ``col`` and its histogram as text.

    ``col`` is rendered as a string with NULL -> ``'NA'``; the text lists
    ``"value: n"`` by count descending, ties by value, joined with ``';; '``.
    Rows with a NULL key are dropped. Both outputs come from one histogram:
    the (group, value) counts are pre-aggregated with map-side combine, so
    only one row per distinct value of a group reaches its final task; the
    text itself lists every distinct value (it is the result, so it is
    neither capped nor sampled).
    """
    text_col = text_col or f"{col}_counts"
    count_col = count_col or f"{col}_distinct"
    # Group on the typed value; only the (group, value) rows are rendered.
    hist = (
        drop_null_keys(df, keys)
        .groupBy(*keys, F.col(col).alias("_v"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    label = na_label("_v").alias("value")
    if df.schema[col].dataType in _ONE_LABEL_EACH:
        hist = hist.select(*keys, label, "n")
    else:
        # A stored 'NA' and NULL are one label: few rows, counted together.
        hist = hist.groupBy(*keys, label).agg(F.sum("n").alias("n"))
    if chunk_size:
        return _chunked_histogram_text(hist, keys, text_col, count_col, chunk_size)
    per_group = hist.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(count_col),
        F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("neg_n"), "value", "n"))).alias("_h"),
    )
    return per_group.select(
        *keys, count_col,
        count_text(F.transform("_h", lambda x: F.struct(x["value"].alias("value"), x["n"].alias("n")))).alias(text_col),
    )


def _chunked_histogram_text(hist: DataFrame, keys: list[str], text_col: str, count_col: str,
                            chunk_size: int) -> DataFrame:
    """Same text, built as a tree: each entry's position in the group's
    display order comes from ``rank_within`` (ranges of count and value, so equal
    counts are split too), runs of ``chunk_size`` entries are rendered by
    separate tasks, and runs of ``chunk_size`` texts are joined, level by level,
    until one is left. No task joins more than ``chunk_size`` pieces of a group
    at once (two if that is one); the last ones hold the text that is the result."""
    placed = rank_within(hist.withColumnRenamed("n", "n_counts"), keys, None, value_col="value")
    most = placed.agg(F.max("rank")).first()[0] or 1
    piece = F.struct("rank", "value", F.col("n_counts").alias("n"))
    level = (
        placed.withColumn("_chunk", F.expr(f"(rank - 1) div {chunk_size}"))
        .groupBy(*keys, "_chunk")
        .agg(F.count(F.lit(1)).alias("_k"), F.array_sort(F.collect_list(piece)).alias("_h"))
        .select(*keys, "_chunk", "_k",
                count_text(F.transform("_h", lambda x: F.struct(x["value"].alias("value"), x["n"].alias("n"))))
                .alias("_text"))
    )
    chunks, fan = -(-most // chunk_size), max(2, chunk_size)
    while chunks > 1:
        level = (
            level.withColumn("_up", F.expr(f"_chunk div {fan}"))
            .groupBy(*keys, F.col("_up"))
            .agg(F.sum("_k").alias("_k"), F.array_sort(F.collect_list(F.struct("_chunk", "_text"))).alias("_parts"))
            .select(*keys, F.col("_up").alias("_chunk"), "_k",
                    F.array_join(F.transform("_parts", lambda x: x["_text"]), ITEM_SEPARATOR).alias("_text"))
        )
        chunks = -(-chunks // fan)
    return level.select(*keys, F.col("_k").alias(count_col), F.col("_text").alias(text_col))


def group_distinct_counts(df: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """Number of distinct values of each column per group, NULL counted as
    one value ('NA'). NULL-key rows dropped. Output ``{col}_distinct``.

    One pass for all columns: rows are stacked as (group, column, value), made
    distinct with map-side combine (the shuffle key holds the value, so a hot
    group is spread), and the rows left are counted per group and column.
    """
    items = F.array(*[F.struct(F.lit(i).alias("i"), na_label(c).alias("value")) for i, c in enumerate(cols)])
    values = (drop_null_keys(df, keys).select(*keys, F.explode(items).alias("_v"))
              .select(*keys, F.col("_v.i").alias("_i"), F.col("_v.value").alias("_value")).distinct())
    return values.groupBy(*keys).agg(*[F.count_if(F.col("_i") == i).alias(f"{c}_distinct") for i, c in enumerate(cols)])


def null_coverage_gaps(df: DataFrame, keys: list[str], measure: str) -> DataFrame:
    """Distinct key tuples that have NULL ``measure`` rows but no non-null
    row (so a group statistic cannot fill them). NULL keys compare equal.

    Same answer as ``distinct(null rows) EXCEPT distinct(non-null rows)``, in
    one aggregation instead of two scans and an anti-join.
    """
    return (
        df.groupBy(*keys)
        .agg(
            F.count_if(F.col(measure).isNull()).alias("_nulls"),
            F.count(F.col(measure)).alias("_values"),
        )
        .where((F.col("_nulls") > 0) & (F.col("_values") == 0))
        .select(*keys)
    )


def repeated_pairs(df: DataFrame, keys: list[str], min_count: int = 2) -> DataFrame:
    """Row count per key tuple, keeping tuples seen at least ``min_count``
    times (HAVING). NULL-key rows dropped. Output: keys, ``n_counts``."""
    return (
        drop_null_keys(df, keys)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_counts"))
        .where(F.col("n_counts") >= min_count)
    )
