import datetime as dt
import os
import uuid

from pyspark.sql import functions as F

from campaign_spark.operators import model_dataset, prediction_points
from campaign_spark.plans.campaign import engineer, join_campaign, run_materialized, strategy_running_totals
from campaign_spark.session import scratch_path
from campaign_spark.sources import (
    column_types_option, materialize, read_campaign_csvs, read_in_order, read_jdbc, stage_exists,
    table_shapes, write_sorted_csv,
)
from campaign_spark.schemas import JOINED
from campaign_spark.streaming import batched_rows
from tests.conftest import rows

D = dt.date


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def _csv_folder(spark):
    folder = scratch_path(spark, "csv_in", uuid.uuid4().hex).replace("file:", "")
    _write(f"{folder}/camp_data.csv",
           "captured_date,business_vertical_id,country_id,region,city_code,strategy_id,channel_name_id,"
           "goal_type,total_spend_cpm,impressions,clicks,conversions\n"
           "2018-09-18,1,1,jakarta,idn-ja-jak,7,1,,1.5,10,1,\n"
           "2018-09-19,2,1,jakarta,idn-ja-jak,7,2,1,0.0,,2,1\n"
           "2018-09-20,9,2,auckland,nz-au-akl,8,1,2,2.0,4,,1\n"
           "2018-09-20,1,3,x,bad,8,1,2,2.0,4,0,1\n")
    _write(f"{folder}/business_vertical.csv", "business_vertical_id,business_vertical\n1,Finance\n2,Unknown\n")
    _write(f"{folder}/country.csv", "country_id,country\n1,Indonesia\n2,New Zealand\n")
    _write(f"{folder}/channel_name.csv", "channel_name_id,channel_name\n1,Display\n2,Mobile\n")
    return folder


def test_csv_sources_to_joined_and_cleansed(spark):
    t = read_campaign_csvs(spark, _csv_folder(spark))
    joined = join_campaign(t["camp_data"], t["business_vertical"], t["country"], t["channel_name"])
    assert joined.schema == JOINED
    got = rows(joined.select("business_vertical", "country", "channel_name"))
    assert got == [("Finance", "Indonesia", "Display"), ("Finance", None, "Display"),
                   ("Unknown", "Indonesia", "Mobile"), (None, "New Zealand", "Display")]
    stages = run_materialized(spark, lambda: joined, strategy_id=7, name=uuid.uuid4().hex)
    c = {r.captured_date: r for r in stages["cleansed"].collect()}
    assert c[D(2018, 9, 19)].impressions == 10.0  # median of Indonesia/jakarta
    assert c[D(2018, 9, 18)].goal_type == 3 and c[D(2018, 9, 18)].conversions == 1.0
    tot = {r.country: r.impressions for r in stages["totals_by_country"].collect()}
    assert tot == {"Indonesia": 20.0, "New Zealand": 4.0}
    assert "year_captured" in stages["engineered"].columns
    run = stages["running_totals"].orderBy("captured_date").collect()
    assert [(r.channel_name, r.impressions_cumul) for r in run] == [("Display", 10.0), ("Mobile", 10.0)]


def test_empty_strategy_selection_keeps_schema(spark):
    df = spark.createDataFrame(
        [(D(2020, 1, 1), "c", "r", 1.0, 1.0, 1, 0.1)],
        "captured_date date, channel_name string, region string, impressions double, clicks double, "
        "strategy_id int, total_spend_cpm double")
    out = strategy_running_totals(df, 999)
    assert out.count() == 0
    assert out.columns == ["captured_date", "impressions", "clicks", "impressions_cumul", "clicks_cumul",
                           "channel_name", "region"]


def test_calendar_features(spark):
    df = spark.createDataFrame([(D(2018, 9, 3),), (None,)], "captured_date date")
    out = engineer(df).orderBy(F.col("captured_date").asc_nulls_last()).collect()
    assert (out[0].year_captured, out[0].yyyymm_captured) == (2018, "201809")
    assert (out[1].year_captured, out[1].yyyymm_captured) == (None, None)


def test_model_dataset_windows(spark):
    rows_ = [(7, D(2020, 1, d), "c", "r", "ch", 1.0, 10.0, 2.0, 1.0) for d in (1, 2, 10, 16, 20, 24, 30)]
    df = spark.createDataFrame(
        rows_, "strategy_id int, captured_date date, country string, region string, channel_name string, "
               "total_spend_cpm double, impressions double, clicks double, conversions double")
    pts = {r.split: r.prediction_date for r in prediction_points(df).collect()}
    assert pts == {"train": D(2020, 1, 16), "validation": D(2020, 1, 23), "test": D(2020, 1, 30)}
    out = {r.split: r for r in model_dataset(df).collect()}
    # train: past = days 1,2,10 ; labels = (16, 23] -> days 20
    assert out["train"].state_rows == 3 and out["train"].state_impressions == 30.0
    assert out["train"].label_impressions == 10.0
    assert out["train"].state_im_cpm == 10.0
    # validation: (23, 30] -> days 24, 30
    assert out["validation"].label_impressions == 20.0
    assert out["test"].label_impressions is None


def test_materialize_reads_existing_stage(spark):
    path = scratch_path(spark, "stage_test", uuid.uuid4().hex)
    calls = []

    def build():
        calls.append(1)
        return spark.range(5)

    assert materialize(spark, build, path).count() == 5
    assert stage_exists(spark, path)
    assert materialize(spark, build, path).count() == 5
    assert len(calls) == 1
    materialize(spark, build, path, refresh=True)
    assert len(calls) == 2


def test_result_csv_round_trip(spark):
    df = spark.createDataFrame([("b", 2.0), ("a", 1.5)], "country string, impressions double")
    path = scratch_path(spark, "result_csv", uuid.uuid4().hex)
    assert write_sorted_csv(df, path, order_by=["country"]) == 1
    back = read_in_order(spark, path, df.schema)
    assert sorted(map(tuple, back.collect())) == [("a", 1.5, 1), ("b", 2.0, 2)]


def test_table_shapes(spark):
    out = rows(table_shapes({"t1": spark.range(3), "t2": spark.range(0).withColumn("x", F.lit(1))}))
    assert out == [("t1", 3, 1), ("t2", 0, 2)]


def test_batched_rows(spark):
    sizes = [len(b) for b in batched_rows(spark.range(0, 2500, 1, 3), 1000)]
    assert sizes == [1000, 1000, 500]


def test_jdbc_options_without_database(spark):
    from pyspark.sql.types import _parse_datatype_string

    opt = column_types_option(["a", "b"], ["INT", "CHAR(1)"])
    assert opt == "a INT, b CHAR(1)"
    assert _parse_datatype_string(opt).simpleString() == "struct<a:int,b:char(1)>"  # Spark accepts it
    import pytest
    with pytest.raises(ValueError):
        read_jdbc(spark, "jdbc:none", table="t", query="select 1")


def test_inferred_csv_and_typed_table_load(spark):
    from campaign_spark.schemas import BUSINESS_VERTICAL
    from campaign_spark.sources import load_csv_table, read_csv_inferred

    folder = _csv_folder(spark)
    inferred = read_csv_inferred(spark, f"{folder}/camp_data.csv")
    types = dict(inferred.dtypes)
    assert types["strategy_id"] == "int" and types["total_spend_cpm"] == "double"
    assert types["captured_date"] == "date"
    tbl = load_csv_table(spark, f"{folder}/business_vertical.csv", BUSINESS_VERTICAL, "bv_" + uuid.uuid4().hex[:8])
    assert rows(tbl) == [(1, "Finance"), (2, "Unknown")]


def test_typed_csv_failfast_on_malformed(spark):
    import pytest

    from campaign_spark.schemas import COUNTRY
    from campaign_spark.sources import read_csv

    folder = scratch_path(spark, "bad_csv", uuid.uuid4().hex).replace("file:", "")
    _write(f"{folder}/country.csv", "country_id,country\nx,Indonesia\n")
    with pytest.raises(Exception):
        read_csv(spark, f"{folder}/country.csv", COUNTRY).collect()


def test_export_results_and_popularity_run(spark):
    from campaign_spark.plans.campaign import export_results
    from campaign_spark.plans.popularity import run_popularity
    from campaign_spark.sources import read_csv

    t = read_campaign_csvs(spark, _csv_folder(spark))
    joined = join_campaign(t["camp_data"], t["business_vertical"], t["country"], t["channel_name"])
    stages = run_materialized(spark, lambda: joined, strategy_id=7, name=uuid.uuid4().hex)
    out = scratch_path(spark, "export", uuid.uuid4().hex)
    export_results({k: v for k, v in stages.items() if k.startswith("totals_by_") or k == "running_totals"}, out)
    back = read_csv(spark, f"{out}/totals_by_country", mode="FAILFAST")
    assert [r.country for r in back.collect()] == ["Indonesia", "New Zealand"]

    ratings = spark.createDataFrame([(1, 10, 4.0), (1, 10, 2.0), (2, 20, 5.0)],
                                    "user_id long, movie_id long, rating double")
    items = spark.createDataFrame([(10, "a", "X|Y"), (20, "b", "Y")], "movie_id long, title string, genres string")
    res = run_popularity(spark, ratings, items, "count", out_dir=out, name=uuid.uuid4().hex)
    assert dict(rows(res["categories"])) == {"X": 1, "Y": 2}
    res = run_popularity(spark, ratings, items, "mean", name=uuid.uuid4().hex)
    assert {r.genre: r.popularity for r in res["categories"].collect()} == {"X": 3.0, "Y": 11.0 / 3}


def test_run_sql_bound_parameters(spark):
    from campaign_spark.sources import register, run_sql

    register({"camp": spark.createDataFrame([(1, "a"), (2, "b")], "id int, c string")})
    out = run_sql(spark, "SELECT c FROM camp WHERE id = :id", {"id": 2})
    assert [r.c for r in out.collect()] == ["b"]


def test_cli_etl_and_popularity(spark):
    from campaign_spark.__main__ import main
    from campaign_spark.sources import read_csv

    folder = _csv_folder(spark)
    out = scratch_path(spark, "cli", uuid.uuid4().hex).replace("file:", "")
    assert main(["etl", "--input", folder, "--output", out, "--strategy", "7"]) == 0
    tot = read_csv(spark, f"{out}/totals_by_country").collect()
    assert [(r.country, r.impressions) for r in tot] == [("Indonesia", "20.0"), ("New Zealand", "4.0")]
    run = read_csv(spark, f"{out}/running_totals").collect()
    assert [r.impressions_cumul for r in run] == ["10.0", "10.0"]

    _write(f"{folder}/movies.csv", "movieId,title,genres\n1,A,X|Y\n2,B,Y\n")
    _write(f"{folder}/ratings.csv", "userId,movieId,rating,timestamp\n1,1,4,0\n1,1,5,0\n2,2,x,0\n3,2,3,0\n")
    assert main(["popularity", "--movies", f"{folder}/movies.csv", "--ratings", f"{folder}/ratings.csv",
                 "--output", out, "--how", "count"]) == 0
    cats = {r.genre: r.popularity for r in read_csv(spark, f"{out}/popularity_count_categories").collect()}
    assert cats == {"X": "1", "Y": "2"}
    assert read_csv(spark, f"{out}/rejected_ratings").count() == 1


def test_approx_median_is_opt_in_and_close(spark):
    from campaign_spark.operators import group_medians

    df = spark.createDataFrame([("a", float(v)) for v in range(1, 1002)], "k string, v double")
    exact = group_medians(df, ["k"], ["v"]).first().median_v
    approx = group_medians(df, ["k"], ["v"], method="approx").first().median_v
    assert exact == 501.0 and abs(approx - exact) <= 1.0
