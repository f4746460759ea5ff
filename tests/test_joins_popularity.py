from pyspark.sql import functions as F

from campaign_spark.operators import Dimension, category_popularity, fits_broadcast, item_popularity, star_join
from campaign_spark.sources import typed_ratings
from tests.conftest import rows


def test_star_join_left_nulls_and_fan_out(spark):
    fact = spark.createDataFrame([(1, 10), (2, 20), (None, 10), (3, 99)], "bv int, co int")
    bv = spark.createDataFrame([(1, "Finance"), (2, "Retail"), (2, "Retail2")], "id int, label string")
    co = spark.createDataFrame([(10, "Indonesia")], "id int, label string")
    out = star_join(fact, [
        Dimension(bv, "bv", "id", {"label": "business_vertical"}),
        Dimension(co, "co", "id", {"label": "country"}, max_broadcast_rows=100),
    ])
    assert rows(out) == [
        (1, 10, "Finance", "Indonesia"), (2, 20, "Retail", None), (2, 20, "Retail2", None),
        (3, 99, None, None), (None, 10, None, "Indonesia"),
    ]


def test_fits_broadcast_bound(spark):
    df = spark.range(10)
    assert fits_broadcast(df, 10) and not fits_broadcast(df, 9)


def _ratings(spark):
    return spark.createDataFrame(
        [(1, 100, 4.0), (1, 100, 5.0), (2, 100, 3.0), (1, 200, 2.0), (3, 300, 1.0)],
        "user_id long, movie_id long, rating double")


def _items(spark):
    return spark.createDataFrame(
        [(100, "A", "Drama|Comedy"), (200, "B", "Drama"), (300, "C", None), (400, "D", "(no genres listed)")],
        "movie_id long, title string, genres string")


def test_item_popularity_count_dedups_users(spark):
    out = rows(item_popularity(_ratings(spark), _items(spark), "count"))
    assert out == [(100, "A", "Drama|Comedy", 2), (200, "B", "Drama", 1), (300, "C", None, 1)]


def test_item_popularity_mean(spark):
    out = {r.movie_id: (r.sum_rating, r.n_ratings, r.popularity)
           for r in item_popularity(_ratings(spark), _items(spark), "mean").collect()}
    assert out[100] == (12.0, 3, 4.0)


def test_genre_popularity_count_and_weighted_mean(spark):
    cnt = dict(rows(category_popularity(_ratings(spark), _items(spark), "count")))
    assert cnt == {"Comedy": 2, "Drama": 3}
    mean = {r.genre: (r.sum_rating, r.n_ratings, r.popularity)
            for r in category_popularity(_ratings(spark), _items(spark), "mean").collect()}
    assert mean["Drama"] == (14.0, 4, 3.5)  # (12 + 2) / (3 + 1), not mean of means
    assert mean["Comedy"] == (12.0, 3, 4.0)


def test_empty_and_single_genres(spark):
    items = spark.createDataFrame([(1, "x", ""), (2, "y", "Solo")], "movie_id long, title string, genres string")
    r = spark.createDataFrame([(9, 1, 1.0), (9, 2, 1.0)], "user_id long, movie_id long, rating double")
    assert dict(rows(category_popularity(r, items, "count"))) == {"": 1, "Solo": 1}


def test_typed_ratings_quarantines_malformed(spark):
    raw = spark.createDataFrame([("1", "10", "4.5"), ("2", "10", "abc"), ("x", "11", "3")],
                                "user_id string, movie_id string, rating string")
    good, bad = typed_ratings(raw)
    assert rows(good) == [(1, 10, 4.5)]
    assert bad.count() == 2
    assert good.schema["rating"].dataType.simpleString() == "double"
    assert good.where(F.col("rating").isNull()).count() == 0
