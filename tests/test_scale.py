"""Plans and results under skew: one key holds a large share of the rows."""

import pytest
from pyspark.sql import functions as F

from stratiform.operators.dedupe import keep_newest
from stratiform.operators.lookup import fits_broadcast, lookup_keys
from stratiform.operators.merge import upsert
from stratiform.plans import gold
from stratiform.plans.model import star_query
from stratiform.workspace import stage

SMALL_SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture
def small_skew(spark):
    for key, value in SMALL_SKEW.items():
        spark.conf.set(key, value)
    yield
    for key in SMALL_SKEW:
        spark.conf.unset(key)


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    execution = df._jdf.queryExecution()
    df._jdf.collectToPython()
    return execution.executedPlan().toString()


@pytest.fixture
def hot_facts(spark):
    """A third of the rows under one key, a tenth under none."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 10 == 1, None).otherwise(
        F.concat(F.lit("k"), F.col("id") % 5000)
    )
    return stage(
        spark.range(0, 60000, 1, 6).select(key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("filler"))
    )


def test_lookup_splits_a_hot_key_when_the_dimension_is_too_large_to_broadcast(spark, small_skew, hot_facts):
    dimension = stage(
        hot_facts.select(F.col("k").alias("id")).filter("id IS NOT NULL").distinct().withColumn("sk", F.hash("id"))
    )
    keyed = lookup_keys(hot_facts, dimension, "id", "sk", {"k": "added"}, limit_bytes=0)
    plan = final_plan(keyed)
    assert "SortMergeJoin(skew=true)" in plan and "Broadcast" not in plan
    assert keyed.count() == 60000
    assert keyed.filter("added IS NULL").count() == hot_facts.filter("k IS NULL").count()


def test_upsert_splits_a_hot_target_key(spark, small_skew, hot_facts):
    target = stage(hot_facts.withColumn("sk", F.monotonically_increasing_id()))
    source = stage(
        spark.range(4000).select(
            F.when(F.col("id") == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") * 2)).alias("k"),
            F.lit("new").alias("filler"),
            (F.col("id") - 10_000).alias("sk"),
        )
    )
    merged = upsert(target, source, ["k"], "sk", source_is_unique=True, limit_bytes=0)
    assert "SortMergeJoin(skew=true)" in final_plan(merged)
    assert merged.filter("k = 'hot' AND filler = 'new' AND sk >= 0").count() == 20000
    known = target.select("k").distinct()
    assert merged.count() == 60000 + source.join(known, "k", "left_anti").count()


def test_small_source_leaves_the_target_unshuffled(spark, hot_facts):
    target = stage(hot_facts.withColumn("sk", F.monotonically_increasing_id()))
    source = stage(target.limit(10))
    merged = upsert(target, source, ["k"], "sk", source_is_unique=True)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_broadcast_needs_a_measured_size(spark):
    wide = stage(spark.range(100).select(F.col("id"), F.repeat(F.lit("x"), 1000).alias("text")))
    assert fits_broadcast(wide, ["id"], ["id", "text"], limit_bytes=50_000) == [True, False]
    assert fits_broadcast(wide, ["id"], ["id", "text"], limit_bytes=500) == [False, False]
    assert fits_broadcast(wide, ["id", "text"], limit_bytes=200_000) == [True]


def test_hot_key_reaches_the_shuffle_once_per_task(spark, hot_facts):
    rows = hot_facts.selectExpr(
        "k", "filler", "'s' AS segment", "2024 AS year", "1 AS month", "1 AS day", "cast(hash(filler) AS bigint) AS load"
    )
    newest = keep_newest(rows, ["k"])
    plan = newest._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning(k")
    assert "WindowGroupLimit" in plan[exchange:] and "Partial" in plan[exchange:]
    assert newest.count() == rows.select("k").distinct().count()
    best = rows.filter("k = 'hot'").agg(F.max("load")).first()[0]
    assert newest.filter("k = 'hot'").first()["load"] == best


def test_gold_plans_push_filters_and_prune_columns(spark):
    weather = stage(
        spark.range(100).selectExpr(
            "id AS weather_sk", "concat('S', id % 3) AS STATION", "'n' AS Station_name", "1d AS LATITUDE",
            "1d AS LONGITUDE", "1d AS ELEVATION", "timestamp_ntz'2024-01-01' AS DATE", "1d AS temperature",
            "1d AS dew_point_temperature", "1d AS station_level_pressure", "1d AS altimeter", "'x' AS unused",
        )
    )
    dates = gold.dim_date([gold.observed_dates(weather, "DATE")])._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<DATE:timestamp_ntz>" in dates
    stations = gold.dim_weather_station(weather)
    fact = gold.fact_weather_observation(weather, stations)
    totals = star_query({"fact_weather_observation": fact}, "fact_weather_observation", ["altimeter"])
    plan = totals._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<STATION:string,altimeter:double>" in plan
    assert "unused" not in plan and "SortMergeJoin" not in plan


def test_taxi_fact_has_no_shuffle(spark):
    trips = spark.sql(
        "SELECT 1L AS trip_sk, timestamp_ntz'2024-01-01' AS tpep_pickup_datetime, timestamp_ntz'2024-01-01' AS "
        "tpep_dropoff_datetime, 1 AS PULocationID, 1 AS DOLocationID, 1 AS VendorID, 1 AS passenger_count, 1 AS "
        "trip_distance, 1 AS fare_amount, 1 AS tip_amount, 1 AS tolls_amount, 1 AS total_amount, 1 AS payment_type"
    )
    plan = gold.fact_taxi_trip(stage(trips))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "date_format" not in plan
