"""Popularity run: per-item aggregates computed once, both outputs written.

The per-item statistics are materialized as a stage, and the item-level and
category-level results are both derived from it. The events are scanned and
aggregated once, however many outputs are written.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campaign_spark.fixed import CATEGORY_SEPARATOR
from campaign_spark.operators.popularity import categories_with, item_stats, items_with
from campaign_spark.sources.ordered import write_sorted_csv
from campaign_spark.sources.stages import materialize, stage_path


def run_popularity(spark: SparkSession, ratings: DataFrame, items: DataFrame, how: str = "count",
                   out_dir: str | None = None, name: str = "popularity", sep: str = CATEGORY_SEPARATOR,
                   item: str = "movie_id", categories: str = "genres",
                   stage: str | None = None, refresh: bool = False) -> dict[str, DataFrame]:
    """``stage`` (a path) keeps the item statistics of one input for later calls; without it every
    call has its own.

    Return (and optionally write as CSV) ``items`` and ``categories``.

    ``items``: items with ratings and their popularity, sorted ascending at
    the sink. ``categories``: per category popularity, sorted descending.
    """
    stats = materialize(spark, lambda: item_stats(ratings, how, item=item),
                        stage or stage_path(spark, name, how, uuid.uuid4().hex), refresh)
    per_item = items_with(stats, items, item)
    per_cat = categories_with(stats, items, how, categories, sep, item)
    if out_dir is not None:
        base = out_dir.rstrip("/")
        write_sorted_csv(per_item, f"{base}/{name}_{how}_items", order_by=["popularity", item])
        write_sorted_csv(per_cat, f"{base}/{name}_{how}_categories",
                         order_by=[F.desc("popularity"), "genre"])
    return {"items": per_item, "categories": per_cat}
