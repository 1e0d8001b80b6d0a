"""The registered queries: every operator run over the whole benchmark tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.operators.dedupe import keep_newest, newest_in_order
from stratiform.operators.merge import upsert
from stratiform.operators.numbering import max_key, number_rows
from stratiform.operators.shape import add_audit_columns, override_types, project
from stratiform.plans import feeds, gold
from stratiform.plans.model import daily_sums, star_query, totals
from stratiform.plans.silver import default_transform, register_transform, run_entity
from stratiform.plans.whole_run import run_all
from stratiform.sinks.tables import append_table, merge_table, replace_table
from stratiform.sources.drift import read_drifting_parquet
from stratiform.sources.landing import land_archive, land_batch
from stratiform.sources.readers import read_source
from stratiform.sources.registry import one_id_per_client
from stratiform.spec import LOAD_COLUMNS, EntitySpec
from stratiform.streaming.incremental import merge_new_loads
from stratiform.workspace import new_path, stage

Query = Callable[[SparkSession, str], DataFrame]

FIRST_LOAD = datetime(2024, 1, 31, 8, 30, 15, 1, tzinfo=timezone.utc)
SECOND_LOAD = datetime(2024, 2, 1, 7, 0, 2, 500, tzinfo=timezone.utc)

LAST_FOLDER = "segment=incremental/year=2024/month=02/day=02/load=070002000500"

DELIVERY_KEY = ["order_key", "line_number"]
ORDER_TYPES = {
    "o_orderkey": "bigint",
    "o_custkey": "bigint",
    "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz",
}
WEATHER_TYPES = {
    "weather_sk": "bigint",
    "LATITUDE": "double",
    "LONGITUDE": "double",
    "ELEVATION": "double",
    "DATE": "timestamp_ntz",
    "temperature": "double",
    "dew_point_temperature": "double",
    "station_level_pressure": "double",
    "altimeter": "double",
}
BIKE_TYPES = {
    "ride_sk": "bigint",
    "started_at": "timestamp_ntz",
    "ended_at": "timestamp_ntz",
    "start_lat": "double",
    "start_lng": "double",
    "end_lat": "double",
    "end_lng": "double",
}


def _new_database(spark: SparkSession) -> str:
    """A database of this call's own, kept in the shared folder."""
    name = f"run_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{new_path(spark, 'db')}'")
    return name


def _spec(format: str, source: str, **more) -> EntitySpec:
    settings = {"load_type": "append", "destination": "unused.unused", "surrogate_key": "sk", **more}
    return EntitySpec(format=format, source=source, **settings)


# Sources


def src_parquet_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, root = feeds.table(spark, sf_dir, "events"), new_path(spark, "bronze")
    land_batch(events, root, "initial", FIRST_LOAD)
    land_batch(events.withColumn("value", F.col("value") * 2), root, "incremental", SECOND_LOAD)
    return read_source(spark, _spec("parquet", root))


def src_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, options = new_path(spark, "bronze"), {"header": "true"}
    land_batch(feeds.table(spark, sf_dir, "orders"), root, "initial", FIRST_LOAD, "csv", options)
    spec = _spec("csv", root, options=options, override_column_types=ORDER_TYPES)
    return override_types(read_source(spark, spec), spec.override_column_types)


def src_psv(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, options = new_path(spark, "bronze"), {"header": "true", "sep": "|"}
    land_batch(feeds.weather(spark, sf_dir), root, "initial", FIRST_LOAD, "csv", options)
    spec = _spec("csv", root, options=options, override_column_types=WEATHER_TYPES)
    return override_types(read_source(spark, spec), spec.override_column_types)


def src_zip_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, options = new_path(spark, "bronze"), {"header": "true", "escape": '"'}
    rides = feeds.bike(spark, sf_dir)
    land_batch(rides, root, "initial", FIRST_LOAD, "zip_csv")
    land_batch(rides.withColumn("member_casual", F.lit("member")), root, "incremental", SECOND_LOAD, "zip_csv")
    # Once more in plain subfolders, where two archives have one name and members differ by folder only.
    later = rides.withColumn("member_casual", F.lit("guest"))
    for half, (folder, member) in enumerate((("x", "a/b.csv"), ("y", "a/b.csv"), ("y", "a__b.csv"))):
        part = later.where((F.pmod("ride_sk", F.lit(3)) == half))
        land_archive(part, f"{root}/{LAST_FOLDER}/{folder}", "trips" if half < 2 else "more", member)
    spec = _spec("zip_csv", root, options=options, override_column_types=BIKE_TYPES)
    return override_types(read_source(spark, spec), spec.override_column_types)


def src_schema_drift_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, root = feeds.table(spark, sf_dir, "lineitem"), new_path(spark, "bronze")
    older = lines.withColumn("l_quantity", F.col("l_quantity").cast("int")).drop("l_linestatus")
    newer = lines.withColumn("l_suppkey", F.col("l_suppkey").cast("double")).withColumn("l_note", F.col("l_returnflag"))
    land_batch(older, root, "initial", FIRST_LOAD)
    land_batch(newer, root, "incremental", SECOND_LOAD)
    types = {"l_quantity": "double", "l_suppkey": "bigint", "not_there": "int"}
    return read_source(spark, _spec("new_york_taxi", root, override_column_types=types))


def src_mixed_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of two layouts in one folder, read a part of them at a time: six files of each, more where the table
    is read in more parts."""
    lines, root = feeds.table(spark, sf_dir, "lineitem"), new_path(spark, "bronze")
    files = max(6, lines.rdd.getNumPartitions())
    older = lines.withColumn("l_quantity", F.col("l_quantity").cast("int")).drop("l_linestatus")
    newer = lines.withColumn("l_suppkey", F.col("l_suppkey").cast("double"))
    for part in (older, newer):
        land_batch(part.repartition(files, "l_orderkey"), root, "initial", FIRST_LOAD)
    types = {"l_quantity": "double", "l_suppkey": "bigint"}
    return read_drifting_parquet(spark, root, types, files_per_scan=files - 1)


def _parts_of_source(file: Column) -> list[Column]:
    """Load folder, mark of an archive and ending of the file that a row names as its source.

    The patterns begin with a fixed character or name, so each takes time linear in the path.
    """
    return [
        F.regexp_extract(file, r"/(segment=.*/load=[0-9]+)/", 1).alias("folder"),
        F.regexp_extract(file, r"(\.zip!)[^.!/]*+\.[a-z]+$", 1).alias("archive"),
        F.regexp_extract(file, r"\.[a-z]+$", 0).alias("ending"),
    ]


def audit_source_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For rows of each format, the load folder and the ending of the file they name as their source."""
    found = None
    for format, name, key in (
        ("parquet", "events", "event_id"),
        ("csv", "orders", "o_orderkey"),
        ("zip_csv", "customer", "c_custkey"),
        ("new_york_taxi", "part", "p_partkey"),
    ):
        rows, root = feeds.table(spark, sf_dir, name), new_path(spark, "bronze")
        landed, options = ("parquet" if format == "new_york_taxi" else format), {"header": "true"}
        land_batch(rows, root, "initial", FIRST_LOAD, landed, options if format == "csv" else None)
        land_batch(rows, root, "incremental", SECOND_LOAD, landed, options if format == "csv" else None)
        spec = _spec(format, root, options=options if "csv" in format else {}, source_file_column="audit_file")
        own = read_source(spark, spec).select(
            F.lit(format).alias("format"),
            F.col(key).cast("bigint").alias("id"),
            *_parts_of_source(F.col("audit_file")),
        )
        found = own if found is None else found.union(own)
    return found


def bronze_land_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_path(spark, "bronze")
    land_batch(feeds.table(spark, sf_dir, "customer"), root, "incremental", SECOND_LOAD)
    return spark.read.parquet(root)


def registry_by_client(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = feeds.table(spark, sf_dir, "orders")
    return one_id_per_client(orders.selectExpr("o_custkey AS ClientGUID", "o_orderkey AS RandomUniqueId"))


# Silver operators


def silver_project_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"]
    types = {"l_orderkey": "string", "l_linenumber": "double", "l_quantity": "int", "l_shipdate": "date"}
    return override_types(project(feeds.table(spark, sf_dir, "lineitem"), columns), types)


def silver_lenient_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = {"l_partkey": "tinyint", "l_returnflag": "double"}
    columns = ["l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_returnflag"]
    df = override_types(project(feeds.table(spark, sf_dir, "lineitem"), columns), types, strict=False)
    return df.withColumn("l_partkey", F.col("l_partkey").cast("int"))


def silver_dedupe_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_newest(feeds.deliveries(spark, sf_dir), DELIVERY_KEY)


def silver_dedupe_full_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = feeds.deliveries(spark, sf_dir)
    return keep_newest(rows.select("order_key", "quantity", "return_flag", *LOAD_COLUMNS))


def surrogate_key_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    used = max_key(feeds.table(spark, sf_dir, "orders"), "o_orderkey")
    keyed = number_rows(keep_newest(feeds.deliveries(spark, sf_dir), DELIVERY_KEY), "delivery_sk", after=used)
    return keyed.agg(
        F.count("delivery_sk").alias("keys"),
        F.min("delivery_sk").alias("lowest"),
        F.max("delivery_sk").alias("highest"),
        F.countDistinct("delivery_sk").alias("different"),
    )


def surrogate_key_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = keep_newest(feeds.deliveries(spark, sf_dir), DELIVERY_KEY).select(*DELIVERY_KEY)
    return number_rows(newest, "delivery_sk", order_by=DELIVERY_KEY)


def audit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    audited = add_audit_columns(feeds.table(spark, sf_dir, "documents"), "documents")
    return audited.withColumn("is_timed", F.col("audit_timestamp").isNotNull()).drop("audit_timestamp")


# Sinks


def _target_and_source(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Deliveries up to 1999 as the table, those from 1998 on as the batch: old, shared and new keys."""
    rows = feeds.deliveries(spark, sf_dir)
    older = newest_in_order(rows.filter("year <= 1999"), DELIVERY_KEY)
    target = number_rows(older, "delivery_sk", order_by=DELIVERY_KEY, ranged=True)
    batch = newest_in_order(rows.filter("year >= 1998"), DELIVERY_KEY)
    source = number_rows(batch, "delivery_sk", max_key(target, "delivery_sk"), order_by=DELIVERY_KEY, ranged=True)
    return target, source


def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source = _target_and_source(spark, sf_dir)
    return upsert(target, source, DELIVERY_KEY, "delivery_sk", source_is_unique=True)


def sink_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source = _target_and_source(spark, sf_dir)
    name = f"{_new_database(spark)}.deliveries"
    merge_table(target, name, DELIVERY_KEY, "delivery_sk")
    merge_table(source, name, DELIVERY_KEY, "delivery_sk")
    return spark.table(name)


def sink_merge_touched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As `sink_merge`, in a table kept in buckets, and then the last day's deliveries again with twice the
    quantity. `rest_untouched` says that a row is in a bucket of those or still in the file it was in before."""
    target, source = _target_and_source(spark, sf_dir)
    name = f"{_new_database(spark)}.deliveries"
    merge_table(target, name, DELIVERY_KEY, "delivery_sk", key_buckets=64)
    merge_table(source, name, DELIVERY_KEY, "delivery_sk")
    day = F.struct("year", "month", "day")
    last = spark.table(name).agg(F.max(day).alias("last"))
    again = spark.table(name).join(F.broadcast(last), day == F.col("last")).where("line_number IS NOT NULL")
    again = stage(again.withColumn("quantity", F.col("quantity") * 2).drop("last"))
    files = stage(spark.table(name).select(F.col("_metadata.file_path").alias("file")).distinct())
    merge_table(again.drop("key_bucket"), name, DELIVERY_KEY, "delivery_sk")
    touched = again.select(F.col("key_bucket").alias("touched")).distinct()
    rows = spark.table(name).select("*", F.col("_metadata.file_path").alias("now"))
    rows = rows.join(F.broadcast(touched), F.col("key_bucket") == F.col("touched"), "left")
    rows = rows.join(files, F.col("now") == F.col("file"), "left")
    rest = F.col("touched").isNotNull() | F.col("file").isNotNull()
    return rows.withColumn("rest_untouched", rest).drop("touched", "file", "now", "key_bucket")


def sink_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, name = feeds.table(spark, sf_dir, "orders"), f"{_new_database(spark)}.orders"
    append_table(orders, name)
    append_table(orders.withColumn("o_orderstatus", F.lit("X")).select(*reversed(orders.columns)), name)
    return spark.table(name)


def sink_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{_new_database(spark)}.parts"
    replace_table(feeds.table(spark, sf_dir, "part"), name)
    replace_table(spark.table(name).withColumn("p_size", F.col("p_size") + 1), name)
    return spark.table(name)


# Gold


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.silver_dates(feeds.taxi(spark, sf_dir), feeds.bike(spark, sf_dir), feeds.weather(spark, sf_dir))


def dim_time_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every minute of the time dimension with the rides that start in it."""
    starts = feeds.bike(spark, sf_dir).groupBy(gold.time_key(F.col("started_at")).alias("time_sk"))
    counted = gold.dim_time(spark).join(starts.agg(F.count(F.lit(1)).alias("rides")), "time_sk", "left")
    return counted.withColumn("rides", F.coalesce("rides", F.lit(0)))


def dim_bike_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_bike_station(feeds.bike(spark, sf_dir))


def dim_weather_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_weather_station(feeds.weather(spark, sf_dir))


def dim_weather_station_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_weather_station(feeds.weather(spark, sf_dir), one_per_id=True)


def fact_taxi_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.fact_taxi_trip(feeds.taxi(spark, sf_dir))


def fact_bike_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rides = feeds.bike(spark, sf_dir)
    return gold.fact_bike_trip(rides, gold.dim_bike_station(rides))


def fact_weather_observation(spark: SparkSession, sf_dir: str) -> DataFrame:
    observations = feeds.weather(spark, sf_dir)
    return gold.fact_weather_observation(observations, gold.dim_weather_station(observations))


# Reports. Measures are summed as decimals, so that a total does not depend on the order of addition.


def _exact(fact: DataFrame, *measures: str) -> DataFrame:
    return fact.withColumns({m: F.col(m).cast("decimal(18,2)") for m in measures})


def _as_double(df: DataFrame, *measures: str) -> DataFrame:
    return df.withColumns({m: F.col(m).cast("double") for m in measures})


WEATHER_MEASURES = ["temperature", "dew_point_temperature", "station_level_pressure", "altimeter"]
TAXI_AMOUNTS = ["trip_distance", "fare_amount", "tip_amount", "tolls_amount", "total_amount"]


def _weather_star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    observations = feeds.weather(spark, sf_dir)
    stations = gold.dim_weather_station(observations)
    return {
        "dim_date": gold.dim_date([gold.observed_dates(observations, "DATE")]),
        "dim_time": gold.dim_time(spark),
        "dim_weather_station": stations,
        "fact_weather_observation": _exact(
            gold.fact_weather_observation(observations, stations), *WEATHER_MEASURES
        ),
    }


def _taxi_star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    trips = feeds.taxi(spark, sf_dir)
    dates = gold.dim_date([gold.observed_dates(trips, "tpep_pickup_datetime", "tpep_dropoff_datetime")])
    return {
        # Written, since a query reads it several times and it is made of a join of the two largest tables.
        "dim_date": stage(dates, "dim_date"),
        "dim_time": gold.dim_time(spark),
        "fact_taxi_trip": _exact(gold.fact_taxi_trip(trips), *TAXI_AMOUNTS),
    }


def _bike_star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    rides = feeds.bike(spark, sf_dir)
    stations = gold.dim_bike_station(rides)
    return {
        "dim_date": gold.dim_date([gold.observed_dates(rides, "started_at", "ended_at")]),
        "dim_time": gold.dim_time(spark),
        "dim_bike_station": stations,
        "fact_bike_trip": gold.fact_bike_trip(rides, stations),
    }


def report_daily_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_double(daily_sums(_weather_star(spark, sf_dir)), *WEATHER_MEASURES)


def report_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_double(totals(_weather_star(spark, sf_dir)), *WEATHER_MEASURES)


def report_star_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = ["dim_weather_station.station_name", "dim_date.is_weekend", "dim_time.part_of_day"]
    sums = star_query(_weather_star(spark, sf_dir), "fact_weather_observation", by=by)
    return _as_double(sums, *WEATHER_MEASURES)


def _taxi_by_month(spark: SparkSession, sf_dir: str, use: Sequence[str] = ()) -> DataFrame:
    by = ["dim_date.year", "dim_date.month", "payment_type"]
    return _as_double(star_query(_taxi_star(spark, sf_dir), "fact_taxi_trip", by=by, use=use), *TAXI_AMOUNTS)


def report_taxi_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _taxi_by_month(spark, sf_dir)


def report_by_dropoff_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _taxi_by_month(spark, sf_dir, use=["dropoff_date_sk"])


def report_filtered_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Card payments on working days of the first quarters, by year."""
    where = {"dim_date.month": [1, 2, 3], "dim_date.day_of_week": (2, 6), "payment_type": 1}
    star = _taxi_star(spark, sf_dir)
    sums = star_query(star, "fact_taxi_trip", by=["dim_date.year", "dim_date.month"], where=where)
    return _as_double(sums, *TAXI_AMOUNTS)


def report_bike_by_start_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = ["dim_bike_station.station_name", "dim_time.part_of_day", "member_casual"]
    return star_query(_bike_star(spark, sf_dir), "fact_bike_trip", by=by)


def report_bike_by_end_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = ["dim_bike_station.station_name", "dim_time.part_of_day", "member_casual"]
    use = ["end_station_sk", "end_time_sk"]
    return star_query(_bike_star(spark, sf_dir), "fact_bike_trip", by=by, use=use)


# Whole runs


def _delivered_twice(spark: SparkSession, sf_dir: str) -> tuple[str, Callable[[], None]]:
    """Land all orders, and later all of them again: finished ones corrected, open ones under a new key."""
    orders, root = feeds.table(spark, sf_dir, "orders"), new_path(spark, "bronze")
    land_batch(orders, root, "initial", FIRST_LOAD)

    def again() -> None:
        corrected = orders.selectExpr(
            "CASE WHEN o_orderstatus = 'O' THEN -o_orderkey ELSE o_orderkey END AS o_orderkey",
            "o_custkey",
            "o_orderstatus",
            "CASE WHEN o_orderstatus = 'F' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice",
            "o_orderdate",
            "o_orderpriority",
        )
        land_batch(corrected, root, "incremental", SECOND_LOAD)

    return root, again


def _orders_spec(root: str, database: str, load_type: str) -> EntitySpec:
    return EntitySpec(
        format="parquet",
        source=root,
        projected_columns=["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", *LOAD_COLUMNS],
        override_column_types={"o_custkey": "string"},
        business_key=["o_orderkey"],
        surrogate_key="order_sk",
        load_type=load_type,
        destination=f"{database}.orders",
    )


def entity_run_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two append runs: the second adds every key again with its newest content."""
    root, deliver_again = _delivered_twice(spark, sf_dir)
    spec = _orders_spec(root, _new_database(spark), "append")
    run_entity(spark, spec)
    first = stage(spark.table(spec.destination).selectExpr("order_sk AS first_sk"))
    deliver_again()
    run_entity(spark, spec)
    return _with_key_facts(spark.table(spec.destination), first)


def _with_key_facts(after: DataFrame, first: DataFrame, key: str = "order_sk") -> DataFrame:
    """Instead of the key: whether it was there after the first run, else whether it lies above all of those,
    and how many different keys there are."""
    keys = after.agg(F.countDistinct(key)).first()[0]
    highest = max_key(first, "first_sk")
    marked = after.join(first, F.col(key) == F.col("first_sk"), "left")
    return marked.withColumns(
        {
            "from_first_run": F.col("first_sk").isNotNull(),
            "key_holds": F.col("first_sk").isNotNull() | (F.col(key) > highest),
            "different_keys": F.lit(keys).cast("bigint"),
        }
    ).drop(key, "first_sk")


def entity_run_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two merge runs: known orders are updated under their old key, new ones get a larger key."""
    root, deliver_again = _delivered_twice(spark, sf_dir)
    spec = _orders_spec(root, _new_database(spark), "merge")
    run_entity(spark, spec)
    before = stage(spark.table(spec.destination).selectExpr("o_orderkey", "order_sk AS first_sk"))
    highest = max_key(before, "first_sk")
    deliver_again()
    run_entity(spark, spec)
    after = spark.table(spec.destination).join(before, "o_orderkey", "left")
    known = F.col("first_sk").isNotNull()
    kept = F.when(known, F.col("order_sk") == F.col("first_sk")).otherwise(F.col("order_sk") > highest)
    return after.withColumns({"known": known, "key_holds": kept}).drop("order_sk", "first_sk")


def incremental_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two incremental runs, each reading only the newly landed folder."""
    root, deliver_again = _delivered_twice(spark, sf_dir)
    spec, checkpoint = _orders_spec(root, _new_database(spark), "merge"), new_path(spark, "progress")
    merge_new_loads(spark, spec, checkpoint)
    first = stage(spark.table(spec.destination).selectExpr("order_sk AS first_sk"))
    deliver_again()
    merge_new_loads(spark, spec, checkpoint)
    return _with_key_facts(spark.table(spec.destination), first)


def _two_new_loads(spark: SparkSession, spec: EntitySpec, land_again: Callable[[], object]) -> DataFrame:
    """Two incremental runs with a landing between them, and a third that finds nothing."""
    checkpoint = new_path(spark, "progress")
    merge_new_loads(spark, spec, checkpoint)
    first = stage(spark.table(spec.destination).select(F.col(spec.surrogate_key).alias("first_sk")))
    land_again()
    merge_new_loads(spark, spec, checkpoint)
    merge_new_loads(spark, spec, checkpoint)
    return _with_key_facts(spark.table(spec.destination), first, spec.surrogate_key)


def incremental_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rides in zip archives, loaded as they arrive: later ones of electric bikes, some under new ids."""
    rides, root = feeds.bike(spark, sf_dir).drop("ride_sk"), new_path(spark, "bronze")
    later = rides.where("rideable_type = 'electric_bike'").withColumn("member_casual", F.lit("guest"))
    renamed = F.when(F.col("start_station_id").isNull(), F.concat(F.lit("N"), "ride_id")).otherwise(F.col("ride_id"))
    land_batch(rides, root, "initial", FIRST_LOAD, "zip_csv")
    spec = EntitySpec(
        format="zip_csv",
        source=root,
        options={"header": "true", "escape": '"'},
        override_column_types={c: t for c, t in BIKE_TYPES.items() if c in rides.columns},
        business_key=["ride_id"],
        surrogate_key="ride_sk",
        load_type="merge",
        destination=f"{_new_database(spark)}.rides",
        key_buckets=16,
    )
    again = lambda: land_batch(later.withColumn("ride_id", renamed), root, "incremental", SECOND_LOAD, "zip_csv")
    return _two_new_loads(spark, spec, again).drop("key_bucket")


def incremental_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in Parquet files whose types and columns differ between loads; the later one lacks the status."""
    orders, root = feeds.table(spark, sf_dir, "orders"), new_path(spark, "bronze")
    land_batch(orders.withColumn("o_totalprice", F.floor("o_totalprice")), root, "initial", FIRST_LOAD)
    later = orders.where("o_orderstatus = 'F'").drop("o_orderstatus")
    later = later.withColumns({"o_custkey": F.col("o_custkey").cast("double"), "o_note": F.lit("late")})
    spec = replace(
        _orders_spec(root, _new_database(spark), "merge"),
        format="new_york_taxi",
        override_column_types={"o_custkey": "bigint", "o_totalprice": "double"},
    )
    return _two_new_loads(spark, spec, lambda: land_batch(later, root, "incremental", SECOND_LOAD))


def incremental_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appended loads, each once."""
    root, deliver_again = _delivered_twice(spark, sf_dir)
    spec = _orders_spec(root, _new_database(spark), "append")
    found = _two_new_loads(spark, spec, deliver_again)
    batches = found.agg(F.countDistinct("load_batch")).first()[0]
    return found.withColumn("batches", F.lit(batches).cast("bigint")).drop("load_batch")


def _finished_only(df: DataFrame, spec: EntitySpec) -> DataFrame:
    """A transform of a user's own: finished orders, with a price class, newest per key, numbered."""
    finished = df.where("o_orderstatus = 'F'").withColumn("dear", F.col("o_totalprice") > 100_000)
    return default_transform(finished, spec)


def entity_run_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two merge runs of an entity with a registered transform."""
    register_transform("finished_only", _finished_only)
    root, deliver_again = _delivered_twice(spark, sf_dir)
    spec = replace(_orders_spec(root, _new_database(spark), "merge"), custom_transform="finished_only")
    run_entity(spark, spec)
    first = stage(spark.table(spec.destination).selectExpr("order_sk AS first_sk"))
    deliver_again()
    run_entity(spark, spec)
    return _with_key_facts(spark.table(spec.destination), first)


def _days_of(star: dict[str, DataFrame]) -> DataFrame:
    """Rides, trips and observations by day, from the gold tables."""
    star = {
        **star,
        "fact_weather_observation": _exact(star["fact_weather_observation"], *WEATHER_MEASURES),
        "fact_taxi_trip": _exact(star["fact_taxi_trip"], *TAXI_AMOUNTS),
    }
    observed = star_query(star, "fact_weather_observation", ["altimeter"], by=["dim_date.date"])
    ridden = star_query(star, "fact_bike_trip", ["duration_seconds"], by=["dim_date.date"])
    driven = star_query(star, "fact_taxi_trip", ["total_amount"], by=["dim_date.date"])
    days = star["dim_date"].select("date_sk", "date", "day_name")
    joined = days.join(observed, "date", "left").join(ridden, "date", "left").join(driven, "date", "left")
    return _as_double(joined, "altimeter", "total_amount")


def gold_star_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Build the whole star as tables and report on it from there: rides and observations by day."""
    database = _new_database(spark)
    star = gold.build_gold(
        spark, feeds.taxi(spark, sf_dir), feeds.bike(spark, sf_dir), feeds.weather(spark, sf_dir), database
    )
    return _days_of(star)


def gold_rides_by_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rides and observations by station and part of day, through the keys of the gold tables as built."""
    database = _new_database(spark)
    star = gold.build_gold(
        spark, feeds.taxi(spark, sf_dir), feeds.bike(spark, sf_dir), feeds.weather(spark, sf_dir), database
    )
    times = star["dim_time"].select("time_sk", "part_of_day")
    bikes = star["dim_bike_station"].selectExpr("station_sk AS key", "station_id", "station_name")
    rides = star["fact_bike_trip"].join(bikes, F.col("start_station_sk") == F.col("key"), "left")
    rides = rides.join(times, F.col("start_time_sk") == F.col("time_sk"), "left")
    weather = star["dim_weather_station"].selectExpr("station_sk AS key", "station_id", "station_name")
    observed = star["fact_weather_observation"].join(weather, F.col("station_sk") == F.col("key"), "left")
    observed = observed.join(times, "time_sk", "left")
    names = ["station_id", "station_name", "part_of_day"]
    counted = [
        df.groupBy(*names).agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), *names, "n")
        for kind, df in (("ride", rides), ("observation", observed))
    ]
    return counted[0].union(counted[1])


def whole_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land all three feeds, the rides and observations twice, and report on the gold that results."""
    root, database = new_path(spark, "lakehouse"), _new_database(spark)
    rides, observations = feeds.bike(spark, sf_dir), feeds.weather(spark, sf_dir)
    trips = feeds.taxi(spark, sf_dir).drop("trip_sk")
    rides, observations = rides.drop("ride_sk"), observations.drop("weather_sk")
    piped = {"header": "true", "sep": "|"}
    later_rides = rides.withColumn("ended_at", F.expr("ended_at + interval '1' hour"))
    later_observations = observations.withColumn("altimeter", F.col("altimeter") + 1)
    landings = [
        lambda: land_batch(trips, f"{root}/new_york_taxi", "initial", FIRST_LOAD),
        lambda: land_batch(rides, f"{root}/citi_bike", "initial", FIRST_LOAD, "zip_csv"),
        lambda: land_batch(later_rides, f"{root}/citi_bike", "incremental", SECOND_LOAD, "zip_csv"),
        lambda: land_batch(observations, f"{root}/weather", "initial", FIRST_LOAD, "csv", piped),
        lambda: land_batch(later_observations, f"{root}/weather", "incremental", SECOND_LOAD, "csv", piped),
    ]
    specs = [
        EntitySpec(
            format="new_york_taxi",
            source="new_york_taxi",
            surrogate_key="trip_sk",
            load_type="append",
            destination=f"{database}.new_york_taxi",
        ),
        EntitySpec(
            format="zip_csv",
            source="citi_bike",
            options={"header": "true", "escape": '"'},
            override_column_types={c: t for c, t in BIKE_TYPES.items() if c in rides.columns},
            business_key=["ride_id"],
            surrogate_key="ride_sk",
            load_type="merge",
            destination=f"{database}.citi_bike",
        ),
        EntitySpec(
            format="csv",
            source="weather",
            options=piped,
            override_column_types={c: t for c, t in WEATHER_TYPES.items() if c in observations.columns},
            business_key=["STATION", "DATE"],
            surrogate_key="weather_sk",
            load_type="merge",
            destination=f"{database}.weather",
        ),
    ]
    star = run_all(spark, specs, root, landings, silver_schema=database, gold_schema=database)
    return _days_of(star)


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        src_parquet_partitioned,
        src_csv,
        src_psv,
        src_zip_csv,
        src_schema_drift_union,
        src_mixed_folder,
        audit_source_files,
        bronze_land_batch,
        registry_by_client,
        silver_project_cast,
        silver_lenient_cast,
        silver_dedupe_latest,
        silver_dedupe_full_row,
        surrogate_key_offset,
        surrogate_key_ordered,
        audit_columns,
        merge_upsert,
        sink_merge,
        sink_merge_touched,
        sink_append,
        sink_overwrite,
        dim_date,
        dim_time_activity,
        dim_bike_station,
        dim_weather_station,
        dim_weather_station_by_id,
        fact_taxi_trip,
        fact_bike_trip,
        fact_weather_observation,
        report_daily_sums,
        report_totals,
        report_star_join,
        report_taxi_measures,
        report_by_dropoff_date,
        report_filtered_star,
        report_bike_by_start_station,
        report_bike_by_end_station,
        entity_run_append,
        entity_run_merge,
        entity_run_custom,
        incremental_merge,
        incremental_zip,
        incremental_drift,
        incremental_append,
        gold_star_build,
        gold_rides_by_station,
        whole_run,
    )
}
