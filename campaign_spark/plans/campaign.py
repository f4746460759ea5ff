"""The campaign analysis as four stages, each a DataFrame function, plus the
materialized run that writes every stage once to the shared folder.

1. joined   - fact star-joined to its label dimensions
2. cleansed - constant fills, integer goal type, per-market median imputation
3. results  - totals by country / channel / vertical and one strategy's
              running totals
4. engineered - cleansed + calendar features
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campaign_spark.fixed import RUNNING_KEYS, RUNNING_OUTPUT_ORDER
from campaign_spark.functions.calendar import year_month_of, year_of
from campaign_spark.functions.nulls import nan_to_null, present
from campaign_spark.functions.ratios import from_units, to_units
from campaign_spark.operators.aggregates import totals_by, totals_by_sets
from campaign_spark.operators.impute import cleanse
from campaign_spark.operators.joins import Dimension, star_join
from campaign_spark.operators.windows import running_totals
from campaign_spark.schemas import BREAKDOWN_KEYS, JOINED_COLUMNS, MEASURES
from campaign_spark.sources.jdbc import write_jdbc
from campaign_spark.sources.ordered import write_sorted_csv
from campaign_spark.sources.stages import materialize, stage_path

RUNNING_OUTPUT = ["captured_date", "impressions", "clicks", "impressions_cumul", "clicks_cumul",
                  "channel_name", "region"]


def join_campaign(camp: DataFrame, business_vertical: DataFrame, country: DataFrame,
                  channel_name: DataFrame) -> DataFrame:
    """Stage 1 from the raw fact and its three (id, label) dimensions."""
    joined = star_join(nan_to_null(camp), [
        Dimension(business_vertical, "business_vertical_id", "business_vertical_id",
                  {"business_vertical": "business_vertical"}),
        Dimension(country, "country_id", "country_id", {"country": "country"}),
        Dimension(channel_name, "channel_name_id", "channel_name_id", {"channel_name": "channel_name"}),
    ])
    return joined.select(*JOINED_COLUMNS)


def engineer(cleansed: DataFrame, date_col: str = "captured_date") -> DataFrame:
    """Stage 4: add ``year_captured`` (INT) and ``yyyymm_captured`` (STRING)."""
    return cleansed.withColumns({
        "year_captured": year_of(date_col),
        "yyyymm_captured": year_month_of(date_col),
    })


def strategy_running_totals(cleansed: DataFrame, strategy_id: int, tiebreak: list[str] | None = None,
                            with_spend: bool = False, sub_blocks: int | None = None,
                            spend_scale: int | None = None) -> DataFrame:
    """Running impressions / clicks (and spend) of one strategy per
    (channel, region) over date. The strategy filter is applied first, so it
    is pushed to the scan and only that strategy's rows are shuffled."""
    one = cleansed.where(F.col("strategy_id") == F.lit(strategy_id))
    measures = ["impressions", "clicks"]
    if with_spend:
        one = one.withColumn("_spend", present("total_spend_cpm") if spend_scale is None
                             else to_units("total_spend_cpm", spend_scale))
        measures.append("_spend")
    out = running_totals(one, RUNNING_KEYS, "captured_date", measures, tiebreak=tiebreak, sub_blocks=sub_blocks)
    if not with_spend:
        return out.select(*RUNNING_OUTPUT)
    total = F.col("_spend_cumul") if spend_scale is None else from_units("_spend_cumul", spend_scale)
    return out.withColumn("cpm_cumul", total).select(
        "captured_date", "impressions", "clicks", "total_spend_cpm", "impressions_cumul", "clicks_cumul",
        "cpm_cumul", "channel_name", "region")


def etl_results(cleansed: DataFrame, strategy_id: int, tiebreak: list[str] | None = None) -> dict[str, DataFrame]:
    """Stage 3 as named frames (lazy)."""
    out = {f"totals_by_{k}": totals_by(cleansed, [k], MEASURES) for k in BREAKDOWN_KEYS}
    out["running_totals"] = strategy_running_totals(cleansed, strategy_id, tiebreak)
    return out


def run_materialized(spark: SparkSession, build_joined, strategy_id: int, tiebreak: list[str] | None = None,
                     name: str | None = None, refresh: bool = False) -> dict[str, DataFrame]:
    """Run all four stages, writing each stage once (Parquet) and reading it
    back. The three breakdowns come from ONE grouping-sets pass over the
    cleansed stage, written once and split by breakdown.

    ``name`` says which stages: those already written under it are read again
    (``refresh`` builds them anew), so one name is for one input. Without a
    name every call has stages of its own."""
    name = name or f"campaign-{uuid.uuid4().hex}"
    joined = materialize(spark, build_joined, stage_path(spark, name, "joined"), refresh)
    # One strategy's rows are neighbours in the files; its dates and the tie-breaks cut a hot one into ranges.
    cleansed = materialize(spark, lambda: cleanse(joined), stage_path(spark, name, "cleansed"), refresh,
                           cluster_by=["strategy_id", "captured_date", *(tiebreak or [])])
    engineered = materialize(spark, lambda: engineer(cleansed), stage_path(spark, name, "engineered"), refresh)
    sets = materialize(spark, lambda: totals_by_sets(cleansed, BREAKDOWN_KEYS, MEASURES),
                       stage_path(spark, name, "totals"), refresh)
    results = {
        f"totals_by_{k}": sets.where(F.col("breakdown") == k).select(F.col("key_value").alias(k), *MEASURES)
        for k in BREAKDOWN_KEYS
    }
    results["running_totals"] = strategy_running_totals(cleansed, strategy_id, tiebreak)
    return {"joined": joined, "cleansed": cleansed, "engineered": engineered, **results}


# Results written by ``export_results`` (column types come from the JDBC
# dialect's mapping of the Spark types: STRING -> text, DOUBLE -> double
# precision, DATE -> date on PostgreSQL, as the source pipeline declared).
RESULT_TABLES = ["totals_by_country", "totals_by_channel_name", "totals_by_business_vertical",
                 "running_totals"]


def export_results(results: dict[str, DataFrame], out_dir: str | None = None, jdbc_url: str | None = None,
                   jdbc_properties: dict[str, str] | None = None, batchsize: int = 100) -> None:
    """Write the stage-3 results: one sorted CSV result each (files in
    order of their names) and, with ``jdbc_url``, a replaced database table
    each (batched inserts, typed columns)."""
    for name, df in results.items():
        if name not in RESULT_TABLES:
            continue
        order = [*RUNNING_OUTPUT_ORDER, *(c for c in df.columns if c not in RUNNING_OUTPUT_ORDER)] if name == "running_totals" else [df.columns[0]]
        if out_dir is not None:
            write_sorted_csv(df, f"{out_dir.rstrip('/')}/{name}", order_by=order)
        if jdbc_url is not None:
            write_jdbc(df, jdbc_url, name, mode="overwrite", batchsize=batchsize,
                       properties=jdbc_properties)
