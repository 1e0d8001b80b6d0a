"""The three silver feeds and the bronze deliveries, expressed over the benchmark tables.

The expressions are plain SQL that Spark and an independent engine read alike, so each feed is stated
once and used both by the queries and by the SQL they are checked against.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

WEATHER = {
    "weather_sk": "event_id + 1",
    "STATION": "concat('ST', user_id % 20)",
    "Station_name": "concat('Station ', user_id % 20, case when user_id % 40 = 0 then ' (moved)' else '' end)",
    "LATITUDE": "cast(40 + user_id % 20 as double)",
    "LONGITUDE": "cast(-74 as double)",
    "ELEVATION": "cast(user_id % 20 as double)",
    "DATE": "ts",
    "temperature": "case when event_id % 50 = 0 then null else value end",
    "dew_point_temperature": "value - 5",
    "station_level_pressure": "value + 1000",
    "altimeter": "value + 1",
}

BIKE = {
    "ride_sk": "event_id + 1",
    "ride_id": "concat('R', event_id)",
    "rideable_type": "case when event_type = 'click' then 'electric_bike' else 'classic_bike' end",
    "started_at": "ts",
    "ended_at": "ts + user_id * interval '1' minute",
    "start_station_id": "case when event_id % 97 = 0 then null else concat('ST', user_id % 40) end",
    "start_station_name": "concat('Station ', user_id % 40, case when event_id % 2 = 0 then ' A' else ' B' end)",
    "end_station_id": "concat('ST', (user_id * 7 + event_id) % 45)",
    "end_station_name": (
        "concat('Station ', (user_id * 7 + event_id) % 45, case when event_id % 3 = 0 then ' A' else ' B' end)"
    ),
    "start_lat": "cast(40 + user_id % 40 as double)",
    "start_lng": "cast(-74 as double)",
    "end_lat": "cast(40 + (user_id * 7 + event_id) % 45 as double)",
    "end_lng": "cast(-74 as double)",
    "member_casual": "case when user_id % 3 = 0 then 'casual' else 'member' end",
}

TAXI = {
    "trip_sk": "l_orderkey * 100 + l_linenumber",
    "tpep_pickup_datetime": "o_orderdate",
    "tpep_dropoff_datetime": "l_shipdate",
    "PULocationID": "l_suppkey",
    "DOLocationID": "l_partkey",
    "VendorID": "case when l_linestatus = 'F' then 1 else 2 end",
    "passenger_count": "l_linenumber",
    "trip_distance": "l_quantity",
    "fare_amount": "l_extendedprice",
    "tip_amount": "l_discount",
    "tolls_amount": "l_tax",
    "total_amount": "l_extendedprice + l_tax",
    "payment_type": "case l_returnflag when 'A' then 1 when 'N' then 2 else 3 end",
}

# Line items as repeated deliveries: (order, line) occurs several times. The last lines of an order
# arrive without a line number, which gives NULL keys.
DELIVERIES = {
    "order_key": "l_orderkey",
    "line_number": "case when l_linenumber = 7 then null else l_linenumber end",
    "part_key": "l_partkey",
    "supplier_key": "l_suppkey",
    "quantity": "l_quantity",
    "price": "l_extendedprice",
    "return_flag": "l_returnflag",
    "segment": "'incremental'",
    "year": "cast(year(l_shipdate) as int)",
    "month": "cast(month(l_shipdate) as int)",
    "day": "cast(day(l_shipdate) as int)",
    "load": "l_partkey",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derive(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{expression} AS {name}" for name, expression in columns.items()])


def as_sql(columns: Mapping[str, str], source: str) -> str:
    return f"SELECT {', '.join(f'{e} AS {n}' for n, e in columns.items())} FROM {source}"


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(table(spark, sf_dir, "events"), WEATHER)


def bike(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(table(spark, sf_dir, "events"), BIKE)


def taxi(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return derive(lines.join(orders, lines.l_orderkey == orders.o_orderkey), TAXI)


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(table(spark, sf_dir, "lineitem"), DELIVERIES)


WEATHER_SQL = as_sql(WEATHER, "events")
BIKE_SQL = as_sql(BIKE, "events")
TAXI_SQL = as_sql(TAXI, "lineitem JOIN orders ON l_orderkey = o_orderkey")
DELIVERIES_SQL = as_sql(DELIVERIES, "lineitem")
