"""Item and category popularity over (user, item, rating) events.

Two definitions: ``count`` = number of distinct users who rated the item;
``mean`` = sum of ratings / number of ratings. Category (genre) popularity
is computed from per-item aggregates joined to the items and exploded over
the item's ``sep``-separated categories: the sum of item popularity for
``count``, and the weighted mean (sum of sums / sum of counts, not a mean of
means) for ``mean``. Events are aggregated per item before any join, so the
join and the explode see one row per item, never one per event.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campaign_spark.fixed import CATEGORY_SEPARATOR
from campaign_spark.functions.ratios import safe_ratio


def _check(how: str) -> None:
    if how not in ("count", "mean"):
        raise ValueError(f"unknown popularity definition {how!r}")


def item_stats(ratings: DataFrame, how: str = "count", user: str = "user_id", item: str = "movie_id",
               rating: str = "rating") -> DataFrame:
    """Per item: ``popularity`` (count) or ``sum_rating``, ``n_ratings``,
    ``popularity`` (mean). Duplicate (user, item) events count once for
    ``count``; ``mean`` keeps every event, like a plain average."""
    _check(how)
    if how == "count":
        return (
            ratings.select(user, item).dropDuplicates([user, item])
            .groupBy(item).agg(F.count(F.lit(1)).alias("popularity"))
        )
    return (
        ratings.groupBy(item)
        .agg(F.sum(rating).alias("sum_rating"), F.count(user).alias("n_ratings"))
        .withColumn("popularity", safe_ratio("sum_rating", "n_ratings"))
    )


def item_popularity(ratings: DataFrame, items: DataFrame, how: str = "count", item: str = "movie_id",
                    **cols: str) -> DataFrame:
    """Items that have ratings, with their popularity (inner join on the id)."""
    return items_with(item_stats(ratings, how, item=item, **cols), items, item)


def items_with(stats: DataFrame, items: DataFrame, item: str = "movie_id") -> DataFrame:
    """Items that have statistics (``item_stats``), with them."""
    return items.join(stats, item, "inner")


def category_popularity(ratings: DataFrame, items: DataFrame, how: str = "count",
                        categories: str = "genres", sep: str = CATEGORY_SEPARATOR, item: str = "movie_id",
                        name: str = "genre", **cols: str) -> DataFrame:
    """Popularity per category. ``count``: ``genre``, ``popularity`` (sum of
    the items' distinct-user counts). ``mean``: ``genre``, ``sum_rating``,
    ``n_ratings``, ``popularity``. A NULL category list contributes nothing;
    an empty string is a category of its own."""
    return categories_with(item_stats(ratings, how, item=item, **cols), items, how, categories, sep, item, name)


def categories_with(stats: DataFrame, items: DataFrame, how: str = "count", categories: str = "genres",
                    sep: str = CATEGORY_SEPARATOR, item: str = "movie_id", name: str = "genre") -> DataFrame:
    """``category_popularity`` from item statistics that are already there."""
    pattern = "\\Q" + sep + "\\E"
    exploded = (
        items.select(item, F.explode(F.split(F.col(categories), pattern, -1)).alias(name))
        .join(stats, item, "inner")
    )
    if how == "count":
        return exploded.groupBy(name).agg(F.sum("popularity").alias("popularity"))
    return (
        exploded.groupBy(name)
        .agg(F.sum("sum_rating").alias("sum_rating"), F.sum("n_ratings").alias("n_ratings"))
        .withColumn("popularity", safe_ratio("sum_rating", "n_ratings"))
    )
