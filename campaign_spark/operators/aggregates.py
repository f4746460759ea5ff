"""Group totals and efficiency ratios.

All group-bys here use Spark's two-phase hash aggregation (partial sums per
map task, then a shuffle of one row per group and task), so a hot key costs
one row per task in the exchange, never its raw rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campaign_spark.functions.nulls import drop_null_keys, nonnull_sum
from campaign_spark.functions.ratios import RATIOS, exact_sum, safe_ratio


def _sum_exprs(measures: list[str], exact: dict[str, int] | None) -> list[Column]:
    exact = exact or {}
    return [
        (exact_sum(m, exact[m]) if m in exact else nonnull_sum(m)).alias(m)
        for m in measures
    ]


def totals_by(
    df: DataFrame,
    keys: list[str],
    measures: list[str],
    exact: dict[str, int] | None = None,
) -> DataFrame:
    """Sum each measure per group, NULL-key rows dropped, all-NULL sum = 0.0.

    ``exact`` maps a measure to a decimal scale: that measure is summed
    exactly as integer units of 10^-scale (order independent, same total as a
    DECIMAL sum) and returned as DOUBLE.
    """
    return drop_null_keys(df, keys).groupBy(*keys).agg(*_sum_exprs(measures, exact))


def totals_by_sets(
    df: DataFrame,
    keys: list[str],
    measures: list[str],
    exact: dict[str, int] | None = None,
) -> DataFrame:
    """Totals for several single-key breakdowns in ONE scan and ONE shuffle.

    Output: ``breakdown`` (key name), ``key_value`` (string), measures. Rows
    with a NULL value of a breakdown's key are left out of that breakdown.
    """
    gid = F.grouping_id(*keys)
    n = len(keys)
    # grouping_id bit for key i is 0 when key i is grouped.
    breakdown = F.coalesce(*[
        F.when(F.col("_gid") == ((1 << n) - 1 - (1 << (n - 1 - i))), F.lit(k))
        for i, k in enumerate(keys)
    ])
    value = F.coalesce(*[F.col(k).cast("string") for k in keys])
    out = (
        df.groupingSets([[k] for k in keys], *keys)
        .agg(*_sum_exprs(measures, exact), gid.alias("_gid"))
    )
    return out.select(
        breakdown.alias("breakdown"), value.alias("key_value"), *measures
    ).where(F.col("key_value").isNotNull())


def with_ratios(df: DataFrame, ratios: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """Append ratio columns ``out = num / den`` (NULL on a zero denominator)."""
    ratios = RATIOS if ratios is None else ratios
    return df.withColumns({out: safe_ratio(num, den) for out, (num, den) in ratios.items()})


def efficiency_by(
    df: DataFrame,
    key: str,
    measures: list[str],
    spend: str = "total_spend_cpm",
    ratios: dict[str, tuple[str, str]] | None = None,
    exact: dict[str, int] | None = None,
) -> DataFrame:
    """Totals of the measures and of spend per key, then the ratios of sums."""
    totals = totals_by(df, [key], [*measures, spend], exact=exact)
    return with_ratios(totals, ratios)


def ratio_of_sums_by(
    df: DataFrame, keys: list[str], num: str, den: str, out: str, exact: dict[str, int] | None = None
) -> DataFrame:
    """Per group: sum(num), sum(den) and their ratio ``out``."""
    totals = totals_by(df, keys, [num, den], exact=exact)
    return totals.withColumn(out, safe_ratio(num, den))
