"""Star queries with conditions on attributes, and jobs that run at the same time."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from stratiform.plans import gold
from stratiform.plans.at_once import run_at_once
from stratiform.plans.model import condition, star_query
from stratiform.workspace import new_path, stage, staging_scope
from test_verdict_cases import staged_folders


@pytest.fixture
def star(spark, tmp_path):
    days = spark.range(400).selectExpr("date_add(date'2023-01-01', cast(id AS int)) AS date")
    rides = spark.range(40_000).selectExpr(
        "id AS bike_trip_sk",
        "cast(date_format(date_add(date'2023-01-01', cast(id % 400 AS int)), 'yyyyMMdd') AS int) AS start_date_sk",
        "cast(date_format(date_add(date'2023-01-01', cast(id % 397 AS int)), 'yyyyMMdd') AS int) AS end_date_sk",
        "cast(id % 1440 AS int) AS start_time_sk",
        "CASE WHEN id % 11 <> 0 THEN id % 7 END AS start_station_sk",
        "if(id % 3 = 0, 'casual', 'member') AS member_casual",
        "id % 100 AS duration_seconds",
    )
    rides.write.partitionBy("start_date_sk").parquet(f"{tmp_path}/rides")
    stations = spark.range(7).selectExpr("id AS station_sk", "concat('S', id) AS station_id", "if(id = 6, NULL, concat('Station ', id % 2)) AS station_name")
    return {
        "dim_date": stage(gold.dim_date([days])),
        "dim_time": gold.dim_time(spark),
        "dim_bike_station": stage(stations),
        "fact_bike_trip": spark.read.parquet(f"{tmp_path}/rides"),
    }


def joined(star, date="start_date_sk"):
    rides = star["fact_bike_trip"]
    dates, stations = star["dim_date"], star["dim_bike_station"].withColumnRenamed("station_sk", "key")
    out = rides.join(dates, rides[date] == dates["date_sk"], "left")
    return out.join(stations, out["start_station_sk"] == stations["key"], "left")


def sums(df, *by):
    return sorted((tuple(r) for r in df.groupBy(*by).agg(F.sum("duration_seconds")).collect()), key=repr)


@pytest.mark.parametrize(
    "where, sql",
    [
        ({"dim_date.month": 3}, "month = 3"),
        ({"dim_date.month": [1, 12], "dim_date.is_weekend": True}, "month IN (1, 12) AND is_weekend"),
        ({"dim_date.day": (10, 12), "member_casual": "casual"}, "day BETWEEN 10 AND 12 AND member_casual = 'casual'"),
        ({"dim_date.day": (30, None)}, "day >= 30"),
        ({"dim_bike_station.station_name": "Station 1", "dim_date.year": 2024}, "station_name = 'Station 1' AND year = 2024"),
        ({"dim_bike_station.station_name": ["Station 0", None]}, "key IS NOT NULL AND (station_name = 'Station 0' OR station_name IS NULL)"),
        ({"dim_bike_station.station_name": None}, "key IS NOT NULL AND station_name IS NULL"),
        ({"dim_date.year": 1999}, "year = 1999"),
        ({"start_station_sk": None}, "start_station_sk IS NULL"),
    ],
)
def test_filtered_sums_equal_plain_sql(star, where, sql):
    got = star_query(star, "fact_bike_trip", by=["dim_date.month", "member_casual"], where=where)
    assert sorted(map(tuple, got.collect()), key=repr) == sums(joined(star).where(sql), "month", "member_casual")


def test_filters_follow_the_relationship_in_use(star):
    got = star_query(star, "fact_bike_trip", by=["member_casual"], where={"dim_date.month": 2}, use=["end_date_sk"])
    assert sorted(map(tuple, got.collect()), key=repr) == sums(joined(star, "end_date_sk").where("month = 2"), "member_casual")


def test_conditions_of_no_value(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "a int")
    count = lambda wanted: df.where(condition(F.col("a"), wanted)).count()
    assert [count(w) for w in ([], [None], (None, None), (2, None), (None, 1), None, 2)] == [0, 1, 2, 1, 1, 1, 1]


def test_a_dimension_prunes_the_partitions_of_the_fact_at_run_time(spark, star):
    query = star_query(star, "fact_bike_trip", where={"dim_date.day": 31})
    plan = query._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "BroadcastHashJoin" in plan and "LeftSemi" in plan
    assert query.collect()[0][0] == joined(star).where("day = 31").agg(F.sum("duration_seconds")).first()[0]


def test_the_range_of_the_chosen_keys_reaches_an_unpartitioned_scan(spark, star):
    flat = stage(star["fact_bike_trip"].select("start_date_sk", "duration_seconds"))
    query = star_query({**star, "fact_bike_trip": flat}, "fact_bike_trip", where={"dim_date.month": 3, "dim_date.year": 2023})
    plan = query._jdf.queryExecution().optimizedPlan().toString()
    assert "start_date_sk#" in plan and ">= 20230301" in plan and "<= 20230331" in plan


def test_steps_run_together_and_in_order(spark):
    together = threading.Barrier(2, timeout=60)

    def meet(done):
        together.wait()
        return spark.range(3).count()

    got = run_at_once(spark, {"c": lambda done: done["a"] + done["b"], "a": meet, "b": meet}, {"c": ["a", "b"]})
    assert got == {"a": 3, "b": 3, "c": 6}
    with pytest.raises(ValueError, match="wait for each other"):
        run_at_once(spark, {"a": len, "b": len}, {"a": ["b"], "b": ["a"]})
    with pytest.raises(ValueError, match="no such step: z"):
        run_at_once(spark, {"a": len}, {"a": ["z"]})


def test_the_first_failure_cancels_the_others_and_starts_nothing_more(spark):
    started = []

    def slow(done):
        started.append("slow")
        return spark.range(0, 400, 1, 400).rdd.map(lambda r: time.sleep(1)).count()

    def fails(done):
        while not started:
            time.sleep(0.05)
        time.sleep(1)
        raise RuntimeError("injected")

    begun = time.time()
    with pytest.raises(RuntimeError, match="injected"):
        run_at_once(spark, {"slow": slow, "fails": fails, "later": lambda done: started.append("later")}, {"later": ["fails"]})
    assert started == ["slow"] and time.time() - begun < 60
    assert spark.range(5).count() == 5


def test_what_threads_stage_is_removed_with_the_scope(spark):
    before = staged_folders(spark)
    with staging_scope(spark):
        run_at_once(spark, {n: lambda done: stage(spark.range(3)).count() for n in "abc"})
        assert len(staged_folders(spark)) == len(before) + 3
    assert staged_folders(spark) == before
    assert new_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
