"""Silver -> gold: the star schema's dimensions and facts."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratiform.functions.calendar import date_key, is_weekend, part_of_day, seconds_between, time_key
from stratiform.operators.lookup import lookup_keys
from stratiform.operators.numbering import number_rows
from stratiform.plans.at_once import AT_ONCE, run_at_once
from stratiform.sinks.tables import replace_table
from stratiform.workspace import staging_scope


def observed_dates(df: DataFrame, *timestamps: str) -> DataFrame:
    """The dates of several timestamp columns, from one scan, one row per date and task at most."""
    days = F.explode(F.array(*[F.to_date(F.col(f"`{c}`")) for c in timestamps]))
    return df.select(days.alias("date")).filter(F.col("date").isNotNull())


def dim_date(feeds: Sequence[DataFrame]) -> DataFrame:
    """One row per date seen in any feed; each feed has a `date` column."""
    day = F.col("date")
    dates = reduce(DataFrame.unionAll, [f.select("date").filter(day.isNotNull()) for f in feeds]).distinct()
    return dates.select(
        date_key(day).alias("date_sk"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).alias("day"),
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        is_weekend(day).alias("is_weekend"),
    )


def silver_dates(taxi: DataFrame, bike: DataFrame, weather: DataFrame) -> DataFrame:
    return dim_date(
        [
            observed_dates(taxi, "tpep_pickup_datetime", "tpep_dropoff_datetime"),
            observed_dates(bike, "started_at", "ended_at"),
            observed_dates(weather, "DATE"),
        ]
    )


def dim_time(spark: SparkSession) -> DataFrame:
    """The 1,440 minutes of a day."""
    minute = F.col("id").cast("int")
    hour = F.floor(minute / 60)
    return spark.range(24 * 60).select(
        minute.alias("time_sk"),
        hour.alias("hour"),
        (minute % 60).alias("minute"),
        part_of_day(hour).alias("part_of_day"),
    )


def dim_bike_station(trips: DataFrame) -> DataFrame:
    """One row per station id that starts or ends a trip, under its first name.

    Both ends come from one scan. Equal names are settled by position, so a rebuild picks the same row.
    """

    def end_of_trip(role: str) -> Column:
        return F.struct(
            F.col(f"{role}_station_id").alias("station_id"),
            F.col(f"{role}_station_name").alias("station_name"),
            F.col(f"{role}_lat").alias("latitude"),
            F.col(f"{role}_lng").alias("longitude"),
        )

    ends = trips.select(F.inline(F.array(end_of_trip("start"), end_of_trip("end")))).filter("station_id IS NOT NULL")
    first = Window.partitionBy("station_id").orderBy("station_name", "latitude", "longitude")
    stations = ends.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1").drop("_rank")
    return _with_station_key(stations, ["station_id"])


def dim_weather_station(observations: DataFrame, one_per_id: bool = False) -> DataFrame:
    """One row per distinct description of a station; `one_per_id` keeps the first description of each id."""
    described = (
        observations.filter("STATION IS NOT NULL")
        .select(
            F.col("STATION").alias("station_id"),
            F.col("Station_name").alias("station_name"),
            F.col("LATITUDE").alias("latitude"),
            F.col("LONGITUDE").alias("longitude"),
            F.col("ELEVATION").alias("elevation"),
        )
        .distinct()
    )
    columns = described.columns
    if one_per_id:
        first = Window.partitionBy("station_id").orderBy(*columns[1:])
        described = described.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1").drop("_rank")
    return _with_station_key(described, columns)


def _with_station_key(stations: DataFrame, order: Sequence[str]) -> DataFrame:
    numbered = number_rows(stations, "station_sk", order_by=order)
    return numbered.select("station_sk", *stations.columns)


def fact_taxi_trip(trips: DataFrame) -> DataFrame:
    """One row per trip; a projection without shuffle."""
    pickup, dropoff = F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")
    return trips.select(
        "trip_sk",
        date_key(pickup).alias("pickup_date_sk"),
        time_key(pickup).alias("pickup_time_sk"),
        date_key(dropoff).alias("dropoff_date_sk"),
        time_key(dropoff).alias("dropoff_time_sk"),
        F.col("PULocationID").alias("pickup_location_id"),
        F.col("DOLocationID").alias("dropoff_location_id"),
        F.col("VendorID").alias("vendor_id"),
        "passenger_count",
        "trip_distance",
        "fare_amount",
        "tip_amount",
        "tolls_amount",
        "total_amount",
        "payment_type",
        seconds_between(pickup, dropoff).alias("trip_duration_seconds"),
    )


def fact_bike_trip(trips: DataFrame, stations: DataFrame) -> DataFrame:
    """One row per ride with the keys of both stations."""
    start, end = F.col("started_at"), F.col("ended_at")
    facts = trips.select(
        F.col("ride_sk").alias("bike_trip_sk"),
        "ride_id",
        date_key(start).alias("start_date_sk"),
        time_key(start).alias("start_time_sk"),
        date_key(end).alias("end_date_sk"),
        time_key(end).alias("end_time_sk"),
        "start_station_id",
        "end_station_id",
        "rideable_type",
        "member_casual",
        seconds_between(start, end).alias("duration_seconds"),
    )
    roles = {"start_station_id": "start_station_sk", "end_station_id": "end_station_sk"}
    keyed = lookup_keys(facts, stations, "station_id", "station_sk", roles)
    return keyed.select(
        *facts.columns[:6], "start_station_sk", "end_station_sk", "rideable_type", "member_casual", "duration_seconds"
    )


def fact_weather_observation(observations: DataFrame, stations: DataFrame) -> DataFrame:
    """One row per observation and description of its station."""
    moment = F.col("DATE")
    measures = ["temperature", "dew_point_temperature", "station_level_pressure", "altimeter"]
    facts = observations.select(
        "weather_sk",
        "STATION",
        date_key(moment).alias("date_sk"),
        time_key(moment).alias("time_sk"),
        *measures,
    )
    keyed = lookup_keys(facts, stations, "station_id", "station_sk", {"STATION": "station_sk"})
    return keyed.select("weather_sk", "station_sk", "date_sk", "time_sk", *measures)


def build_gold(
    spark: SparkSession,
    taxi: DataFrame,
    bike: DataFrame,
    weather: DataFrame,
    schema: str = "gold",
    at_once: int = AT_ONCE,
) -> dict[str, DataFrame]:
    """Rebuild the whole star: tables that do not need each other at the same time, facts with looked-up keys
    against the dimensions as written.

    Station keys are ranks and change between builds, so facts are always rebuilt with them. The first failure
    stops the build. What is staged on the way is removed afterwards.
    """

    def publish(name: str, build: Callable[[dict], DataFrame]) -> Callable[[dict], DataFrame]:
        def run(done: dict) -> DataFrame:
            replace_table(build(done), f"{schema}.{name}")
            return spark.table(f"{schema}.{name}")

        return run

    builders = {
        "dim_date": lambda done: silver_dates(taxi, bike, weather),
        "dim_time": lambda done: dim_time(spark),
        "dim_bike_station": lambda done: dim_bike_station(bike),
        "dim_weather_station": lambda done: dim_weather_station(weather),
        "fact_taxi_trip": lambda done: fact_taxi_trip(taxi),
        "fact_bike_trip": lambda done: fact_bike_trip(bike, done["dim_bike_station"]),
        "fact_weather_observation": lambda done: fact_weather_observation(weather, done["dim_weather_station"]),
    }
    after = {"fact_bike_trip": ["dim_bike_station"], "fact_weather_observation": ["dim_weather_station"]}
    with staging_scope(spark):
        built = run_at_once(spark, {name: publish(name, build) for name, build in builders.items()}, after, at_once)
    return {name: built[name] for name in builders}
