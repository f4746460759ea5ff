"""Exact, linearly interpolated quantiles per group (median, quartiles).

Plan (``method="bucketed"``, the default):

1. Stack the measures into (keys, measure, value) and count each distinct
   value per group with ``groupBy`` (map-side combine; the shuffle key
   includes the value, so a hot group is spread over many tasks).
2. Range-partition that histogram on (group, value) and write it once with the
   number of each row's range (``ordering.in_order``). All that follows reads
   those files, so there is one source of range boundaries.
3. Count rows per (group, range), a small table, and find with a window over it
   which range holds each target rank and how many rows precede it.
4. Walk only those ranges in value order (a window per (group, range)) and
   pick the values at ranks ``floor(h)`` and ``ceil(h)``, ``h = (n - 1) * p``.

No task ever holds all the rows, or all the distinct values, of one group.
``method="window"`` skips steps 2-3 and walks each group's whole histogram in
one window task (fewer stages; fine when groups have few distinct values).
``method="builtin"`` is Spark's exact ``percentile`` (one in-memory value map
per group). All three give the same numbers. ``method="approx"`` (opt-in,
never the default) returns ``percentile_approx`` values instead: one pass,
bounded memory, not interpolated.

Interpolation: ``v_lo + (h - floor(h)) * (v_hi - v_lo)`` (NumPy/pandas
default). NULL and NaN values are skipped.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campaign_spark.functions.nulls import drop_null_keys
from campaign_spark.operators.ordering import BLOCK, in_order, with_before

SKETCH_ACCURACY = 1_000


def stack_measures(df: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """Long form (keys..., measure, value) of the non-null, non-NaN values."""
    items = F.array(*[
        F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value"))
        for c in cols
    ])
    return (
        df.select(*keys, F.explode(items).alias("_m"))
        .select(*keys, "_m.measure", "_m.value")
        .where(F.col("value").isNotNull() & ~F.isnan("value"))
    )


def _rank_bounds(total: Column, p: float) -> tuple[Column, Column, Column]:
    h = (total - F.lit(1)) * F.lit(float(p))
    return F.floor(h), F.ceil(h), h - F.floor(h)


def _ranked_window(hist: DataFrame, part: list[str]) -> DataFrame:
    """Every histogram row with its running count ``cum`` and group ``total``."""
    ordered = Window.partitionBy(*part).orderBy("value")
    return hist.select(
        *part, "value",
        F.sum("n").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("cum"),
        F.sum("n").over(Window.partitionBy(*part)).alias("total"),
    )


def _ranked_bucketed(hist: DataFrame, part: list[str], probs: list[float], buckets: int | None) -> DataFrame:
    """Only the histogram rows of the ranges holding a target rank, with the same ``cum`` / ``total`` as
    ``_ranked_window`` would give them.

    ``buckets``: number of ranges over all groups; None leaves it to the session's shuffle partitions."""
    placed = with_before(in_order(hist, [*part, "value"], "quantiles", buckets), part, F.col("n"))
    before, size = F.col("__before"), F.col("__block_n")
    holds = []
    for p in probs:
        lo, hi, _ = _rank_bounds(F.col("__all"), p)
        holds += [(before <= lo) & (lo < before + size), (before <= hi) & (hi < before + size)]
    # The condition reads the table of ranges alone, so it is applied before the rows are joined to it.
    targets = placed.where(reduce(lambda a, b: a | b, holds))
    inside = Window.partitionBy(*part, BLOCK).orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return targets.select(*part, "value", (before + F.sum("n").over(inside)).alias("cum"), F.col("__all").alias("total"))


def _ranked(df: DataFrame, keys: list[str], cols: list[str], probs: list[float], method: str,
            buckets: int | None) -> DataFrame:
    """Histogram rows (at least those around every target rank) with their
    running count ``cum`` and group size ``total``, per (keys, measure)."""
    src = drop_null_keys(df, keys) if keys else df
    part = [*keys, "measure"]
    hist = (
        stack_measures(src, keys, cols)
        .groupBy(*part, "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    if method == "window":
        return _ranked_window(hist, part)
    if method == "bucketed":
        return _ranked_bucketed(hist, part, probs, buckets)
    raise ValueError(f"unknown quantile method {method!r}")


def _pick(p: float, when: Column | None = None) -> Column:
    """Interpolated quantile ``p`` as an aggregate over ranked rows (restricted
    to the rows where ``when`` holds, e.g. one measure)."""
    lo, hi, frac = _rank_bounds(F.col("total"), p)
    keep = (lambda c: c) if when is None else (lambda c: when & c)
    v_lo = F.min(F.when(keep(F.col("cum") > lo), F.col("value")))
    v_hi = F.min(F.when(keep(F.col("cum") > hi), F.col("value")))
    fr = F.max(F.when(keep(F.lit(True)), frac))
    return F.when(fr == 0, v_lo).otherwise(v_lo + fr * (v_hi - v_lo))


def quantiles_long(
    df: DataFrame,
    keys: list[str],
    cols: list[str],
    probs: list[float],
    method: str = "bucketed",
    buckets: int | None = None,
) -> DataFrame:
    """Exact quantiles as rows: keys..., measure, q0..q{k-1} (one per prob), n.

    Groups with a NULL key are dropped (group-by semantics of the source
    pipeline); a group whose values are all NULL yields no row.
    """
    ranked = _ranked(df, keys, cols, probs, method, buckets)
    return ranked.groupBy(*keys, "measure").agg(
        *[_pick(p).alias(f"q{i}") for i, p in enumerate(probs)], F.max("total").alias("n"))


def group_quantiles(
    df: DataFrame,
    keys: list[str],
    cols: list[str],
    prob: float,
    prefix: str,
    method: str = "bucketed",
    buckets: int | None = None,
) -> DataFrame:
    """One quantile per measure as wide columns ``{prefix}{col}`` per group,
    picked and pivoted in a single aggregation."""
    src = drop_null_keys(df, keys) if keys else df
    if method == "approx":
        # Opt-in: bounded-memory sketch, rank error about 1/SKETCH_ACCURACY.
        out = src.groupBy(*keys).agg(*[
            F.percentile_approx(F.when(~F.isnan(c), F.col(c).cast("double")), F.lit(prob), 10 * SKETCH_ACCURACY)
            .alias(prefix + c)
            for c in cols
        ])
        return out.where(F.coalesce(*[F.col(prefix + c) for c in cols]).isNotNull())
    if method == "builtin":
        out = src.groupBy(*keys).agg(*[
            F.percentile(F.when(~F.isnan(c), F.col(c).cast("double")), F.lit(prob)).alias(prefix + c)
            for c in cols
        ])
        # Same contract as the other methods: no row for a group without values.
        return out.where(F.coalesce(*[F.col(prefix + c) for c in cols]).isNotNull())
    ranked = _ranked(src, keys, cols, [prob], method, buckets)
    return ranked.groupBy(*keys).agg(*[
        _pick(prob, F.col("measure") == F.lit(c)).alias(prefix + c) for c in cols
    ])


def group_medians(
    df: DataFrame, keys: list[str], cols: list[str], prefix: str = "median_", method: str = "bucketed"
) -> DataFrame:
    """Exact median of each measure per group (NULLs skipped, NULL keys dropped)."""
    return group_quantiles(df, keys, cols, 0.5, prefix, method)
