"""SQL twins (DuckDB dialect) of the registered queries, over the test
tables as views. Each statement inlines the campaign binding so it needs
nothing but the base tables. Column names equal the Spark outputs.
"""

from __future__ import annotations

from campaign_spark.fixed import CATEGORICAL

# The joined campaign table (same rows as plans.fixtures.campaign_joined).
CAMP = """
camp AS (
  SELECT CAST(l_shipdate AS DATE) AS captured_date,
         p.p_type AS business_vertical,
         r_name AS country,
         n.n_name AS region,
         CASE WHEN o_orderstatus = 'P' THEN o_orderpriority
              ELSE r_name || '-' || o_orderpriority END AS city_code,
         l_suppkey AS strategy_id,
         ch.channel_label AS channel_name,
         CASE WHEN l_linenumber % 3 = 0 THEN NULL
              ELSE CAST(l_linenumber % 3 AS DOUBLE) END AS goal_type,
         l_tax AS total_spend_cpm,
         CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity END AS impressions,
         CASE WHEN l_linenumber = 6 THEN NULL
              ELSE CAST(ROUND(l_discount * 100) AS DOUBLE) END AS clicks,
         CASE WHEN l_returnflag = 'N' THEN NULL
              ELSE CAST(l_linenumber AS DOUBLE) END AS conversions,
         l_orderkey, l_partkey, l_linenumber
  FROM lineitem
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN (SELECT * FROM nation WHERE n_nationkey <> 13) n ON c_nationkey = n.n_nationkey
  LEFT JOIN region ON n.n_regionkey = r_regionkey
  LEFT JOIN (SELECT * FROM part WHERE p_partkey % 10 <> 0) p ON l_partkey = p.p_partkey
  LEFT JOIN (SELECT DISTINCT CAST(o_orderpriority[1] AS INTEGER) AS channel_id, o_orderpriority AS channel_label
             FROM orders) ch ON CAST(o_orderpriority[1] AS INTEGER) = ch.channel_id
)"""

CLEANSED = CAMP + """,
med_i AS (
  SELECT country, region, median(impressions) AS median_impressions FROM camp
  WHERE impressions IS NOT NULL AND country IS NOT NULL AND region IS NOT NULL
  GROUP BY country, region
),
med_c AS (
  SELECT country, region, median(clicks) AS median_clicks FROM camp
  WHERE clicks IS NOT NULL AND country IS NOT NULL AND region IS NOT NULL
  GROUP BY country, region
),
cleansed AS (
  SELECT c.captured_date, c.business_vertical, c.country, c.region, c.city_code, c.strategy_id,
         c.channel_name, CAST(COALESCE(c.goal_type, 3.0) AS INTEGER) AS goal_type, c.total_spend_cpm,
         COALESCE(c.impressions, i.median_impressions) AS impressions,
         COALESCE(c.clicks, k.median_clicks) AS clicks,
         COALESCE(c.conversions, 1.0) AS conversions,
         c.l_orderkey, c.l_partkey, c.l_linenumber,
         i.median_impressions, k.median_clicks
  FROM camp c
  LEFT JOIN med_i i ON c.country = i.country AND c.region = i.region
  LEFT JOIN med_c k ON c.country = k.country AND c.region = k.region
)"""

ENGINEERED = CLEANSED + """,
eng AS (
  SELECT *, CAST(year(captured_date) AS INTEGER) AS year_captured,
         strftime(captured_date, '%Y%m') AS yyyymm_captured
  FROM cleansed
)"""

RATINGS = """
ratings AS (
  SELECT o_custkey AS user_id, l_partkey AS movie_id, CAST(l_quantity AS DOUBLE) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
items AS (
  SELECT p_partkey AS movie_id, p_brand AS title, replace(p_name, ' ', '|') AS genres FROM part
)"""

MEASURE_SUMS = """COALESCE(SUM(impressions), 0.0) AS impressions,
       COALESCE(SUM(clicks), 0.0) AS clicks,
       COALESCE(SUM(conversions), 0.0) AS conversions"""

SPEND_SUM = "COALESCE(CAST(SUM(CAST(total_spend_cpm AS DECIMAL(18,4))) AS DOUBLE), 0.0) AS total_spend_cpm"

RATIO_COLS = """impressions / NULLIF(total_spend_cpm, 0) AS im_cpm,
       clicks / NULLIF(total_spend_cpm, 0) AS clicks_cpm,
       conversions / NULLIF(total_spend_cpm, 0) AS conversions_cpm,
       clicks / NULLIF(impressions, 0) AS clicks_im,
       conversions / NULLIF(impressions, 0) AS conversions_im,
       conversions / NULLIF(clicks, 0) AS conversions_clicks"""


def _totals(key: str) -> str:
    return f"""WITH {CLEANSED}
SELECT {key}, {MEASURE_SUMS}
FROM cleansed WHERE {key} IS NOT NULL GROUP BY {key}"""


def _efficiency(key: str) -> str:
    return f"""WITH {CLEANSED},
t AS (
  SELECT {key}, {MEASURE_SUMS}, {SPEND_SUM}
  FROM cleansed WHERE {key} IS NOT NULL GROUP BY {key}
)
SELECT *, {RATIO_COLS} FROM t"""


def _hist_text(keys: list[str], col: str, extra_where: str = "") -> str:
    k = ", ".join(keys)
    not_null = " AND ".join(f"{c} IS NOT NULL" for c in keys)
    return f"""WITH {CLEANSED},
h AS (
  SELECT {k}, COALESCE(CAST({col} AS VARCHAR), 'NA') AS v, COUNT(*) AS n
  FROM cleansed WHERE {not_null} GROUP BY ALL
),
g AS (
  SELECT {k}, COUNT(*) AS {col}_distinct,
         string_agg(v || ': ' || CAST(n AS VARCHAR), ';; ' ORDER BY n DESC, v) AS {col}_counts
  FROM h GROUP BY ALL
)
SELECT * FROM g {extra_where}"""


def _gaps(keys: list[str], measure: str) -> str:
    k = ", ".join(keys)
    return f"""WITH {CAMP}
SELECT {k} FROM camp WHERE {measure} IS NULL
EXCEPT
SELECT {k} FROM camp WHERE {measure} IS NOT NULL"""


RUNNING_WINDOW = """(PARTITION BY channel_name, region
                ORDER BY captured_date ASC NULLS LAST, l_orderkey, l_partkey, l_linenumber
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""

LAST_DATE = CLEANSED + """,
last AS (
  SELECT strategy_id, MAX(captured_date) AS last_date FROM cleansed
  WHERE strategy_id IS NOT NULL GROUP BY strategy_id
),
with_last AS (
  SELECT c.*, l.last_date FROM cleansed c LEFT JOIN last l ON c.strategy_id = l.strategy_id
)"""


def _top_values(where: str = "") -> str:
    parts = "\n  UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COALESCE(CAST({c} AS VARCHAR), 'NA') AS value FROM eng {where}"
        for c in CATEGORICAL
    )
    return f"""WITH {ENGINEERED},
long AS (
  {parts}
),
counts AS (SELECT column_name, value, COUNT(*) AS n_counts FROM long GROUP BY column_name, value),
ranked AS (
  SELECT column_name, value, n_counts,
         CAST(ROW_NUMBER() OVER (PARTITION BY column_name ORDER BY n_counts DESC, value) AS INTEGER) AS value_rank
  FROM counts
)
SELECT * FROM ranked WHERE value_rank <= 10"""


def _column_distinct_counts() -> str:
    parts = "\n  UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(DISTINCT COALESCE(CAST({c} AS VARCHAR), 'NA')) AS n_distinct FROM eng"
        for c in CATEGORICAL
    )
    return f"""WITH {ENGINEERED}
{parts}"""


def _numeric_profile() -> str:
    parts = "\n  UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, COUNT({c}) AS n_values,
         ROUND(AVG({c}), 9) AS mean, ROUND(STDDEV_SAMP({c}), 9) AS std,
         MIN({c}) AS min_value, quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50,
         quantile_cont({c}, 0.75) AS p75, MAX({c}) AS max_value, COUNT(*) - COUNT({c}) AS n_null
  FROM cleansed"""
        for c in ["total_spend_cpm", "impressions", "clicks"]
    )
    return f"""WITH {CLEANSED}
{parts}"""


MODEL = LAST_DATE + """,
keyed AS (
  SELECT * FROM with_last
  WHERE strategy_id IS NOT NULL AND country IS NOT NULL AND region IS NOT NULL
    AND channel_name IS NOT NULL
),
rows3 AS (
  SELECT *, 'train' AS split, CAST(last_date - 14 AS DATE) AS prediction_date FROM keyed
  UNION ALL SELECT *, 'validation', CAST(last_date - 7 AS DATE) FROM keyed
  UNION ALL SELECT *, 'test', last_date FROM keyed
),
agg AS (
  SELECT strategy_id, split, prediction_date, country, region, channel_name,
    CAST(SUM(CASE WHEN captured_date < prediction_date
                  THEN CAST(total_spend_cpm AS DECIMAL(18,4)) END) AS DOUBLE) AS state_total_spend_cpm,
    SUM(CASE WHEN captured_date < prediction_date THEN impressions END) AS state_impressions,
    SUM(CASE WHEN captured_date < prediction_date THEN clicks END) AS state_clicks,
    SUM(CASE WHEN captured_date < prediction_date THEN conversions END) AS state_conversions,
    COUNT(CASE WHEN captured_date < prediction_date THEN 1 END) AS state_rows,
    CASE WHEN MAX(last_date) > prediction_date THEN COALESCE(SUM(CASE WHEN captured_date > prediction_date
         AND captured_date <= prediction_date + 7 THEN impressions END), 0.0) END AS label_impressions,
    CASE WHEN MAX(last_date) > prediction_date THEN COALESCE(SUM(CASE WHEN captured_date > prediction_date
         AND captured_date <= prediction_date + 7 THEN clicks END), 0.0) END AS label_clicks,
    CASE WHEN MAX(last_date) > prediction_date THEN COALESCE(SUM(CASE WHEN captured_date > prediction_date
         AND captured_date <= prediction_date + 7 THEN conversions END), 0.0) END AS label_conversions
  FROM rows3
  WHERE prediction_date IS NOT NULL
  GROUP BY strategy_id, split, prediction_date, country, region, channel_name
)
SELECT *,
  state_impressions / NULLIF(state_total_spend_cpm, 0) AS state_im_cpm,
  state_clicks / NULLIF(state_total_spend_cpm, 0) AS state_clicks_cpm,
  state_conversions / NULLIF(state_total_spend_cpm, 0) AS state_conversions_cpm,
  state_clicks / NULLIF(state_impressions, 0) AS state_clicks_im,
  state_conversions / NULLIF(state_impressions, 0) AS state_conversions_im,
  state_conversions / NULLIF(state_clicks, 0) AS state_conversions_clicks
FROM agg"""

_ITEM_RESULT = f"""WITH {RATINGS},
pop AS (
  SELECT movie_id, COUNT(*) AS popularity FROM (SELECT DISTINCT user_id, movie_id FROM ratings) d
  GROUP BY movie_id
)
SELECT movie_id, title, pop.popularity, ROW_NUMBER() OVER (ORDER BY pop.popularity, movie_id) AS position
FROM items JOIN pop USING (movie_id)"""


def _inferred_profile() -> str:
    types = {"captured_date": "date", "country": "string", "region": "string", "strategy_id": "int",
             "impressions": "double", "clicks": "double", "remark": "string"}
    parts = [f"SELECT '{c}' AS column_name, '{t}' AS inferred_type, COUNT({c}) FILTER (l_linenumber <> 7) AS n_values, "
             "COUNT(*) FILTER (l_linenumber = 7) AS n_bad_rows FROM raw" for c, t in types.items()]
    return f"WITH {CAMP}, raw AS (SELECT *, 'x' AS remark FROM camp)\n" + "\nUNION ALL ".join(parts)


ORACLE: dict[str, str] = {
    "campaign_joined": f"WITH {CAMP} SELECT * FROM camp",
    "campaign_cleansed": f"WITH {CLEANSED} SELECT * FROM cleansed",
    "calendar_features": f"WITH {ENGINEERED} SELECT * FROM eng",
    "totals_by_country": _totals("country"),
    "totals_by_channel": _totals("channel_name"),
    "totals_by_vertical": _totals("business_vertical"),
    "totals_one_pass": f"""WITH {CLEANSED}
SELECT 'country' AS breakdown, CAST(country AS VARCHAR) AS key_value, {MEASURE_SUMS}
FROM cleansed WHERE country IS NOT NULL GROUP BY country
UNION ALL
SELECT 'channel_name', CAST(channel_name AS VARCHAR), {MEASURE_SUMS}
FROM cleansed WHERE channel_name IS NOT NULL GROUP BY channel_name
UNION ALL
SELECT 'business_vertical', CAST(business_vertical AS VARCHAR), {MEASURE_SUMS}
FROM cleansed WHERE business_vertical IS NOT NULL GROUP BY business_vertical""",
    "efficiency_by_country": _efficiency("country"),
    "efficiency_by_channel": _efficiency("channel_name"),
    "efficiency_by_vertical": _efficiency("business_vertical"),
    "strategy_running_totals": f"""WITH {CLEANSED}
SELECT captured_date, impressions, clicks,
       CASE WHEN impressions IS NULL THEN NULL ELSE SUM(impressions) OVER w END AS impressions_cumul,
       CASE WHEN clicks IS NULL THEN NULL ELSE SUM(clicks) OVER w END AS clicks_cumul,
       channel_name, region
FROM cleansed
WHERE strategy_id = 3 AND channel_name IS NOT NULL AND region IS NOT NULL
WINDOW w AS {RUNNING_WINDOW}""",
    "strategy_running_totals_split": f"""WITH {CLEANSED}
SELECT captured_date, impressions, clicks,
       CASE WHEN impressions IS NULL THEN NULL ELSE SUM(impressions) OVER w END AS impressions_cumul,
       CASE WHEN clicks IS NULL THEN NULL ELSE SUM(clicks) OVER w END AS clicks_cumul,
       channel_name, region
FROM cleansed
WHERE strategy_id = 3 AND channel_name IS NOT NULL AND region IS NOT NULL
WINDOW w AS {RUNNING_WINDOW}""",
    "strategy_running_totals_with_spend": f"""WITH {CLEANSED}
SELECT captured_date, impressions, clicks, total_spend_cpm,
       CASE WHEN impressions IS NULL THEN NULL ELSE SUM(impressions) OVER w END AS impressions_cumul,
       CASE WHEN clicks IS NULL THEN NULL ELSE SUM(clicks) OVER w END AS clicks_cumul,
       CASE WHEN total_spend_cpm IS NULL THEN NULL
            ELSE CAST(SUM(CAST(total_spend_cpm AS DECIMAL(18,4))) OVER w AS DOUBLE) END AS cpm_cumul,
       channel_name, region
FROM cleansed
WHERE strategy_id = 3 AND channel_name IS NOT NULL AND region IS NOT NULL
WINDOW w AS {RUNNING_WINDOW}""",
    "spend_per_impression_daily": f"""WITH {CLEANSED},
t AS (
  SELECT captured_date, channel_name, {SPEND_SUM}, COALESCE(SUM(impressions), 0.0) AS impressions
  FROM cleansed WHERE captured_date IS NOT NULL AND channel_name IS NOT NULL
  GROUP BY captured_date, channel_name
)
SELECT *, total_spend_cpm / NULLIF(impressions, 0) AS cpm_per_impression FROM t""",
    "top_values": _top_values(),
    "regions_by_country": f"""WITH {CLEANSED},
counts AS (
  SELECT country, COALESCE(region, 'NA') AS region, COUNT(*) AS n_counts
  FROM cleansed WHERE country IS NOT NULL GROUP BY ALL
)
SELECT *, ROW_NUMBER() OVER (PARTITION BY country ORDER BY n_counts DESC, region) AS value_rank
FROM counts""",
    "column_distinct_counts": _column_distinct_counts(),
    "top_regions_by_country": f"""WITH {CLEANSED},
counts AS (
  SELECT country, COALESCE(region, 'NA') AS region, COUNT(*) AS n_counts
  FROM cleansed WHERE country IS NOT NULL GROUP BY ALL
),
ranked AS (
  SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY country ORDER BY n_counts DESC, region) AS INTEGER)
         AS value_rank
  FROM counts
)
SELECT * FROM ranked WHERE value_rank <= 10""",
    "strategy_top_values": _top_values("WHERE strategy_id = 3"),
    "numeric_profile": _numeric_profile(),
    "code_compliance": f"""WITH {CLEANSED}
SELECT CASE WHEN len(string_split(city_code, '-')) = 3 THEN 'compliant' ELSE city_code END AS code_label,
       COUNT(*) AS n_counts
FROM cleansed WHERE city_code IS NOT NULL GROUP BY ALL""",
    "strategy_country_text": _hist_text(["strategy_id"], "country"),
    "strategy_channel_text": _hist_text(["strategy_id"], "channel_name"),
    "strategy_vertical_text": _hist_text(["strategy_id"], "business_vertical"),
    "strategy_goal_type_text": _hist_text(["strategy_id"], "goal_type"),
    "strategy_date_text": _hist_text(["strategy_id"], "captured_date"),
    "strategy_date_text_chunked": _hist_text(["strategy_id"], "captured_date"),
    "sparse_strategies": _hist_text(["strategy_id"], "captured_date", "WHERE captured_date_distinct <= 500"),
    "strategy_distinct_counts": f"""WITH {CLEANSED}
SELECT strategy_id,
       COUNT(DISTINCT COALESCE(CAST(captured_date AS VARCHAR), 'NA')) AS captured_date_distinct,
       COUNT(DISTINCT COALESCE(CAST(country AS VARCHAR), 'NA')) AS country_distinct,
       COUNT(DISTINCT COALESCE(CAST(channel_name AS VARCHAR), 'NA')) AS channel_name_distinct
FROM cleansed WHERE strategy_id IS NOT NULL GROUP BY strategy_id""",
    "strategy_date_count_join": f"""WITH {CLEANSED},
c AS (
  SELECT strategy_id, COUNT(DISTINCT COALESCE(CAST(captured_date AS VARCHAR), 'NA')) AS date_count
  FROM cleansed WHERE strategy_id IS NOT NULL GROUP BY strategy_id
),
h AS (
  SELECT strategy_id, COALESCE(CAST(captured_date AS VARCHAR), 'NA') AS v, COUNT(*) AS n
  FROM cleansed WHERE strategy_id IS NOT NULL GROUP BY ALL
),
t AS (
  SELECT strategy_id, string_agg(v || ': ' || CAST(n AS VARCHAR), ';; ' ORDER BY n DESC, v)
         AS captured_date_counts
  FROM h GROUP BY strategy_id
)
SELECT c.strategy_id, c.date_count, t.captured_date_counts FROM c JOIN t ON c.strategy_id = t.strategy_id""",
    "strategies_per_market": _hist_text(["country", "region", "channel_name"], "strategy_id"),
    "dates_per_market": _hist_text(["country", "region", "channel_name"], "captured_date"),
    "market_pair_counts": f"""WITH {CLEANSED}
SELECT country, region, COUNT(*) AS n_counts FROM cleansed
WHERE country IS NOT NULL AND region IS NOT NULL GROUP BY country, region""",
    "impression_gaps_by_market": _gaps(["country", "region"], "impressions"),
    "click_gaps_by_market": _gaps(["country", "region"], "clicks"),
    "impression_gaps_by_strategy_date": _gaps(["strategy_id", "captured_date"], "impressions"),
    "repeated_city_days": f"""WITH {CLEANSED}
SELECT city_code, captured_date, COUNT(*) AS n_counts FROM cleansed
WHERE city_code IS NOT NULL AND captured_date IS NOT NULL
GROUP BY city_code, captured_date HAVING COUNT(*) >= 2""",
    "market_filter": f"""WITH {CLEANSED}
SELECT * FROM cleansed WHERE strategy_id = 3 AND captured_date <= DATE '1995-06-17'""",
    "date_cutoff_counts": f"""WITH {CLEANSED}
SELECT captured_date, COUNT(*) AS n_counts FROM cleansed
WHERE captured_date < DATE '1995-06-17' GROUP BY captured_date""",
    "null_impression_rows": f"WITH {CAMP} SELECT * FROM camp WHERE impressions IS NULL",
    "strategy_last_date": f"WITH {LAST_DATE} SELECT * FROM last",
    "rows_before_last_date": f"""WITH {LAST_DATE}
SELECT * FROM with_last WHERE captured_date IS NULL OR last_date IS NULL OR captured_date <> last_date""",
    "rows_on_last_date": f"WITH {LAST_DATE} SELECT * FROM with_last WHERE captured_date = last_date",
    "split_rows_union": f"WITH {LAST_DATE} SELECT * FROM with_last",
    "distinct_countries": f"WITH {CLEANSED} SELECT DISTINCT COALESCE(country, 'NA') AS country FROM cleansed",
    "market_keys": f"WITH {CLEANSED} SELECT DISTINCT country, region FROM cleansed",
    "movie_popularity": f"""WITH {RATINGS},
pop AS (
  SELECT movie_id, COUNT(*) AS popularity FROM (SELECT DISTINCT user_id, movie_id FROM ratings) d
  GROUP BY movie_id
)
SELECT i.movie_id, i.title, i.genres, p.popularity FROM items i JOIN pop p ON i.movie_id = p.movie_id""",
    "movie_popularity_mean": f"""WITH {RATINGS},
pop AS (
  SELECT movie_id, SUM(rating) AS sum_rating, COUNT(user_id) AS n_ratings FROM ratings GROUP BY movie_id
)
SELECT i.movie_id, i.title, i.genres, p.sum_rating, p.n_ratings,
       p.sum_rating / NULLIF(p.n_ratings, 0) AS popularity
FROM items i JOIN pop p ON i.movie_id = p.movie_id""",
    "genre_popularity": f"""WITH {RATINGS},
pop AS (
  SELECT movie_id, COUNT(*) AS popularity FROM (SELECT DISTINCT user_id, movie_id FROM ratings) d
  GROUP BY movie_id
),
g AS (SELECT movie_id, unnest(string_split(genres, '|')) AS genre FROM items WHERE genres IS NOT NULL)
SELECT g.genre, CAST(SUM(p.popularity) AS BIGINT) AS popularity FROM g JOIN pop p ON g.movie_id = p.movie_id
GROUP BY g.genre""",
    "top_genres": f"""WITH {RATINGS},
pop AS (
  SELECT movie_id, COUNT(*) AS popularity FROM (SELECT DISTINCT user_id, movie_id FROM ratings) d
  GROUP BY movie_id
),
g AS (SELECT movie_id, unnest(string_split(genres, '|')) AS genre FROM items WHERE genres IS NOT NULL),
t AS (SELECT g.genre, CAST(SUM(p.popularity) AS BIGINT) AS popularity FROM g JOIN pop p ON g.movie_id = p.movie_id
      GROUP BY g.genre)
SELECT genre, popularity, CAST(ROW_NUMBER() OVER (ORDER BY popularity DESC, genre) AS INTEGER) AS position
FROM t QUALIFY position <= 10""",
    "rarest_movies": f"""WITH {RATINGS},
pop AS (
  SELECT movie_id, COUNT(*) AS popularity FROM (SELECT DISTINCT user_id, movie_id FROM ratings) d
  GROUP BY movie_id
)
SELECT movie_id, p.popularity, CAST(ROW_NUMBER() OVER (ORDER BY p.popularity, movie_id) AS INTEGER) AS position
FROM items JOIN pop p USING (movie_id) QUALIFY position <= 10""",
    "unfilled_strategy_days": f"""WITH {CAMP}
SELECT strategy_id, captured_date FROM camp WHERE impressions IS NULL
EXCEPT SELECT strategy_id, captured_date FROM camp WHERE impressions IS NOT NULL""",
    "genre_popularity_mean": f"""WITH {RATINGS},
pop AS (
  SELECT movie_id, SUM(rating) AS sum_rating, COUNT(user_id) AS n_ratings FROM ratings GROUP BY movie_id
),
g AS (SELECT movie_id, unnest(string_split(genres, '|')) AS genre FROM items WHERE genres IS NOT NULL),
t AS (
  SELECT g.genre, SUM(p.sum_rating) AS sum_rating, SUM(p.n_ratings) AS n_ratings
  FROM g JOIN pop p ON g.movie_id = p.movie_id GROUP BY g.genre
)
SELECT genre, sum_rating, CAST(n_ratings AS BIGINT) AS n_ratings,
       sum_rating / NULLIF(n_ratings, 0) AS popularity FROM t""",
    "rating_user_item_pairs": f"WITH {RATINGS} SELECT DISTINCT user_id, movie_id FROM ratings",
    "model_prediction_points": f"""WITH {LAST_DATE}
SELECT strategy_id, 'train' AS split, CAST(last_date - 14 AS DATE) AS prediction_date FROM last
WHERE last_date IS NOT NULL
UNION ALL SELECT strategy_id, 'validation', CAST(last_date - 7 AS DATE) FROM last WHERE last_date IS NOT NULL
UNION ALL SELECT strategy_id, 'test', last_date FROM last WHERE last_date IS NOT NULL""",
    "model_dataset": f"WITH {MODEL}",
    "table_shapes": f"""WITH {CAMP}
SELECT 'lineitem' AS table_name, COUNT(*) AS n_rows, 11 AS n_cols FROM lineitem
UNION ALL SELECT 'orders', COUNT(*), 6 FROM orders
UNION ALL SELECT 'customer', COUNT(*), 5 FROM customer
UNION ALL SELECT 'nation', COUNT(*), 3 FROM nation
UNION ALL SELECT 'region', COUNT(*), 2 FROM region
UNION ALL SELECT 'part', COUNT(*), 6 FROM part
UNION ALL SELECT 'campaign', COUNT(*), 12 FROM camp""",
    "csv_round_trip": f"WITH {CAMP} SELECT * FROM camp",
    "parquet_stage_round_trip": f"WITH {CLEANSED} SELECT * FROM cleansed",
    "ratings_csv_typed": f"WITH {RATINGS} SELECT * FROM ratings",
    "item_result_csv": _ITEM_RESULT,
    "item_result_first_rows": _ITEM_RESULT + " QUALIFY position <= 10",
    "csv_inferred_profile": _inferred_profile(),
    "bulk_load_round_trip": f"WITH {CAMP} SELECT * FROM camp",
    "bound_strategy_totals": f"""WITH {CLEANSED}
SELECT channel_name, country, COUNT(*) AS n_rows, COALESCE(SUM(impressions), 0.0) AS impressions
FROM cleansed WHERE strategy_id = 3 AND captured_date <= DATE '1995-06-17' AND channel_name <> '5-LOW'
GROUP BY channel_name, country""",
    "channel_fan_out": f"""WITH {CAMP},
channel AS (SELECT DISTINCT CAST(o_orderpriority[1] AS INTEGER) AS id, o_orderpriority AS label FROM orders),
twice AS (SELECT id, label FROM channel UNION ALL SELECT id, 'group ' || CAST(id % 2 AS VARCHAR) FROM channel)
SELECT t.label, COUNT(*) AS n_rows, COALESCE(SUM(impressions), 0.0) AS impressions
FROM camp LEFT JOIN twice t ON CAST(channel_name[1] AS INTEGER) = t.id GROUP BY t.label""",
    "repeated_channel_city_days": f"""WITH {CLEANSED}
SELECT strategy_id, channel_name, city_code, captured_date, COUNT(*) AS n_counts FROM cleansed
WHERE strategy_id IS NOT NULL AND channel_name IS NOT NULL AND city_code IS NOT NULL AND captured_date IS NOT NULL
GROUP BY ALL HAVING COUNT(*) >= 2""",
    "impression_gaps_by_market_date": _gaps(["country", "region", "captured_date"], "impressions"),
    "click_gaps_by_market_date": _gaps(["country", "region", "captured_date"], "clicks"),
}
