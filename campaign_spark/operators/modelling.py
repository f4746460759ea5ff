"""Modelling table around each group's last date (described, not coded, in
the source analysis; this is our reading of it).

For every strategy three prediction dates are derived from its last date:
train = last - 14 days, validation = last - 7 days, test = last. For each
(strategy, split, country, region, channel) the *state* features aggregate
everything strictly before the prediction date (spend and the efficiency
ratios of sums), and the *labels* sum the measures in the 7 days after it
(``p < date <= p + 7``). Test labels lie beyond the data, so they are NULL.

Plan: one join of the rows to their strategy's last date (a maximum over two
columns of a pruned scan; AQE broadcasts it when small), then ONE grouped
aggregation with a set of conditional sums per split, combined in each task
before the shuffle. The splits become rows of the result at the very end, so no
input row is repeated. No interval join and no per-group task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campaign_spark.functions.nulls import drop_null_keys, present

from campaign_spark.functions.ratios import RATIOS, from_units, safe_ratio, to_units
from campaign_spark.operators.joins import attach_group_value

from campaign_spark.fixed import LABEL_DAYS, SPLITS


def prediction_points(df: DataFrame, key: str = "strategy_id", date_col: str = "captured_date",
                      splits: list[tuple[str, int]] | None = None) -> DataFrame:
    """``key``, ``split``, ``prediction_date`` for each group."""
    splits = SPLITS if splits is None else splits
    arr = F.array(*[F.struct(F.lit(s).alias("split"), F.lit(o).alias("offset")) for s, o in splits])
    last = drop_null_keys(df, [key]).groupBy(key).agg(F.max(date_col).alias("_last"))
    return last.select(key, "_last", F.explode(arr).alias("_s")).select(
        key, F.col("_s.split").alias("split"),
        F.date_sub(F.col("_last"), F.col("_s.offset")).alias("prediction_date"),
    ).where(F.col("prediction_date").isNotNull())


def model_dataset(df: DataFrame, key: str = "strategy_id", date_col: str = "captured_date",
                  by: list[str] | None = None, measures: list[str] | None = None,
                  spend: str = "total_spend_cpm", splits: list[tuple[str, int]] | None = None,
                  label_days: int = LABEL_DAYS, spend_scale: int | None = None) -> DataFrame:
    """State features and labels per (key, split, *by)."""
    by = ["country", "region", "channel_name"] if by is None else by
    measures = ["impressions", "clicks", "conversions"] if measures is None else measures
    splits = SPLITS if splits is None else splits
    one = present(spend) if spend_scale is None else to_units(spend, spend_scale)
    rows = drop_null_keys(df, [key]).select(key, date_col, *by, one.alias("_spent"), *[F.col(m).alias(f"_m_{m}") for m in measures])
    # The last date is the strategy's over ALL its rows; then rows without a
    # complete (country, region, channel) key are left out of the groups.
    rows = drop_null_keys(attach_group_value(rows, [key], F.max(date_col), "_last"), by)
    d, last = F.col(date_col), F.col("_last")
    sums = []
    for k, (_, offset) in enumerate(splits):
        p = F.date_sub(last, offset)
        past, future = d < p, (d > p) & (d <= F.date_add(p, label_days))
        sums.append(F.sum(F.when(past, F.col("_spent"))).alias(f"_spent{k}"))
        sums.append(F.count_if(past).alias(f"_rows{k}"))
        sums += [F.sum(F.when(past, F.col(f"_m_{m}"))).alias(f"_state{k}_{m}") for m in measures]
        sums += [F.sum(F.when(future, F.col(f"_m_{m}"))).alias(f"_label{k}_{m}") for m in measures]
    groups = rows.groupBy(key, *by).agg(F.max(last).alias("_last"), *sums)
    points = []
    for k, (split, offset) in enumerate(splits):
        p = F.date_sub("_last", offset)
        spent = F.col(f"_spent{k}") if spend_scale is None else from_units(f"_spent{k}", spend_scale)
        labels = [F.when(F.col("_last") > p, F.coalesce(F.col(f"_label{k}_{m}"), F.lit(0.0))).alias(f"label_{m}") for m in measures]
        points.append(F.struct(F.lit(split).alias("split"), p.alias("prediction_date"), spent.alias(f"state_{spend}"),
                               *[F.col(f"_state{k}_{m}").alias(f"state_{m}") for m in measures],
                               F.col(f"_rows{k}").alias("state_rows"), *labels))
    out = groups.select(key, *by, F.explode(F.array(*points)).alias("_p")).select(
        key, "_p.split", "_p.prediction_date", *by, f"_p.state_{spend}", *[f"_p.state_{m}" for m in measures], "_p.state_rows",
        *[f"_p.label_{m}" for m in measures])
    ratios = {f"state_{o}": safe_ratio(f"state_{n}", f"state_{dd}") for o, (n, dd) in RATIOS.items()}
    return out.withColumns(ratios)
