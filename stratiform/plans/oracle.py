"""For each registered query, SQL text that an independent engine runs on the same tables."""

from __future__ import annotations

from stratiform.plans.feeds import BIKE_SQL, DELIVERIES_SQL, TAXI_SQL, WEATHER_SQL

FIRST = "'initial' AS segment, 2024 AS year, 1 AS month, 31 AS day, CAST(83015000001 AS BIGINT) AS load"
SECOND = "'incremental' AS segment, 2024 AS year, 2 AS month, 1 AS day, CAST(70002000500 AS BIGINT) AS load"

FIRST_FOLDER = "segment=initial/year=2024/month=01/day=31/load=083015000001"
SECOND_FOLDER = "segment=incremental/year=2024/month=02/day=01/load=070002000500"

NEWEST = "year DESC, month DESC, day DESC, load DESC"
DELIVERY_TIES = (
    "part_key DESC, supplier_key DESC, quantity DESC NULLS LAST, price DESC NULLS LAST, "
    "return_flag DESC NULLS LAST, segment DESC NULLS LAST"
)
DELIVERY_COLUMNS = (
    "order_key, line_number, part_key, supplier_key, quantity, price, return_flag, segment, year, month, day, load"
)


def _newest_deliveries(where: str = "TRUE") -> str:
    return f"""
        SELECT {DELIVERY_COLUMNS} FROM (
            SELECT *, ROW_NUMBER() OVER (
                PARTITION BY order_key, line_number ORDER BY {NEWEST}, {DELIVERY_TIES}) AS rn
            FROM ({DELIVERIES_SQL}) AS d WHERE {where}) AS ranked
        WHERE rn = 1"""


def _date_sk(ts: str) -> str:
    return f"CAST(strftime({ts}, '%Y%m%d') AS INTEGER)"


def _time_sk(ts: str) -> str:
    return f"CAST(hour({ts}) * 60 + minute({ts}) AS INTEGER)"


def _seconds(start: str, end: str) -> str:
    return f"CAST(floor(epoch({end})) AS BIGINT) - CAST(floor(epoch({start})) AS BIGINT)"


def _dates(*selects: str) -> str:
    return f"""
        SELECT CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_sk, date,
            CAST(year(date) AS INTEGER) AS year, CAST(quarter(date) AS INTEGER) AS quarter,
            CAST(month(date) AS INTEGER) AS month, monthname(date) AS month_name,
            CAST(day(date) AS INTEGER) AS day, CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week,
            dayname(date) AS day_name, dayofweek(date) IN (0, 6) AS is_weekend
        FROM (SELECT DISTINCT date FROM ({' UNION ALL '.join(selects)}) AS feeds) AS dates WHERE date IS NOT NULL"""


def _day_of(column: str, feed: str) -> str:
    return f"SELECT CAST({column} AS DATE) AS date FROM ({feed}) AS f"


TAXI_DAYS = (_day_of("tpep_pickup_datetime", TAXI_SQL), _day_of("tpep_dropoff_datetime", TAXI_SQL))
BIKE_DAYS = (_day_of("started_at", BIKE_SQL), _day_of("ended_at", BIKE_SQL))
WEATHER_DAYS = (_day_of('"DATE"', WEATHER_SQL),)

TIMES = """
    SELECT CAST(m AS INTEGER) AS time_sk, CAST(m // 60 AS BIGINT) AS hour, CAST(m % 60 AS INTEGER) AS minute,
        CASE WHEN m // 60 < 6 THEN 'Night' WHEN m // 60 < 12 THEN 'Morning'
             WHEN m // 60 < 18 THEN 'Afternoon' ELSE 'Evening' END AS part_of_day
    FROM range(1440) AS r(m)"""

BIKE_STATIONS = f"""
    SELECT CAST(ROW_NUMBER() OVER (ORDER BY station_id) AS BIGINT) AS station_sk,
        station_id, station_name, latitude, longitude
    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY station_id ORDER BY station_name NULLS FIRST,
            latitude NULLS FIRST, longitude NULLS FIRST) AS rn
        FROM (SELECT start_station_id AS station_id, start_station_name AS station_name,
                start_lat AS latitude, start_lng AS longitude FROM ({BIKE_SQL}) AS s
            UNION ALL
            SELECT end_station_id, end_station_name, end_lat, end_lng FROM ({BIKE_SQL}) AS e) AS ends
        WHERE station_id IS NOT NULL) AS ranked
    WHERE rn = 1"""

WEATHER_DESCRIPTIONS = f"""
    SELECT DISTINCT STATION AS station_id, Station_name AS station_name, LATITUDE AS latitude,
        LONGITUDE AS longitude, ELEVATION AS elevation
    FROM ({WEATHER_SQL}) AS w WHERE STATION IS NOT NULL"""

WEATHER_STATIONS = f"""
    SELECT CAST(ROW_NUMBER() OVER (ORDER BY station_id, station_name, latitude, longitude, elevation) AS BIGINT)
        AS station_sk, * FROM ({WEATHER_DESCRIPTIONS}) AS d"""

WEATHER_STATIONS_BY_ID = f"""
    SELECT CAST(ROW_NUMBER() OVER (ORDER BY station_id) AS BIGINT) AS station_sk,
        station_id, station_name, latitude, longitude, elevation
    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY station_id
            ORDER BY station_name, latitude, longitude, elevation) AS rn
        FROM ({WEATHER_DESCRIPTIONS}) AS d) AS ranked
    WHERE rn = 1"""

TAXI_FACT = f"""
    SELECT trip_sk, {_date_sk('tpep_pickup_datetime')} AS pickup_date_sk,
        {_time_sk('tpep_pickup_datetime')} AS pickup_time_sk,
        {_date_sk('tpep_dropoff_datetime')} AS dropoff_date_sk,
        {_time_sk('tpep_dropoff_datetime')} AS dropoff_time_sk,
        PULocationID AS pickup_location_id, DOLocationID AS dropoff_location_id, VendorID AS vendor_id,
        passenger_count, trip_distance, fare_amount, tip_amount, tolls_amount, total_amount, payment_type,
        {_seconds('tpep_pickup_datetime', 'tpep_dropoff_datetime')} AS trip_duration_seconds
    FROM ({TAXI_SQL}) AS t"""

BIKE_FACT = f"""
    SELECT b.ride_sk AS bike_trip_sk, b.ride_id, {_date_sk('b.started_at')} AS start_date_sk,
        {_time_sk('b.started_at')} AS start_time_sk, {_date_sk('b.ended_at')} AS end_date_sk,
        {_time_sk('b.ended_at')} AS end_time_sk, s.station_sk AS start_station_sk,
        e.station_sk AS end_station_sk, b.rideable_type, b.member_casual,
        {_seconds('b.started_at', 'b.ended_at')} AS duration_seconds
    FROM ({BIKE_SQL}) AS b
    LEFT JOIN ({BIKE_STATIONS}) AS s ON b.start_station_id = s.station_id
    LEFT JOIN ({BIKE_STATIONS}) AS e ON b.end_station_id = e.station_id"""

WEATHER_FACT = f"""
    SELECT w.weather_sk, s.station_sk, {_date_sk('w."DATE"')} AS date_sk, {_time_sk('w."DATE"')} AS time_sk,
        w.temperature, w.dew_point_temperature, w.station_level_pressure, w.altimeter
    FROM ({WEATHER_SQL}) AS w LEFT JOIN ({WEATHER_STATIONS}) AS s ON w.STATION = s.station_id"""


def _exact_sums(*measures: str) -> str:
    return ", ".join(f"CAST(SUM(CAST({m} AS DECIMAL(18,2))) AS DOUBLE) AS {m}" for m in measures)


WEATHER_SUMS = _exact_sums("temperature", "dew_point_temperature", "station_level_pressure", "altimeter")
TAXI_SUMS = (
    "CAST(SUM(passenger_count) AS BIGINT) AS passenger_count, "
    + _exact_sums("trip_distance", "fare_amount", "tip_amount", "tolls_amount", "total_amount")
    + ", CAST(SUM(trip_duration_seconds) AS BIGINT) AS trip_duration_seconds"
)


def _taxi_by_month(date_column: str) -> str:
    return f"""
        SELECT d.year, d.month, f.payment_type, {TAXI_SUMS} FROM ({TAXI_FACT}) AS f
        LEFT JOIN ({_dates(*TAXI_DAYS)}) AS d ON f.{date_column} = d.date_sk
        GROUP BY d.year, d.month, f.payment_type"""


def _bike_by_station(role: str) -> str:
    return f"""
        SELECT s.station_name, t.part_of_day, f.member_casual,
            CAST(SUM(f.duration_seconds) AS BIGINT) AS duration_seconds
        FROM ({BIKE_FACT}) AS f
        LEFT JOIN ({BIKE_STATIONS}) AS s ON f.{role}_station_sk = s.station_sk
        LEFT JOIN ({TIMES}) AS t ON f.{role}_time_sk = t.time_sk
        GROUP BY s.station_name, t.part_of_day, f.member_casual"""


MERGE = f"""
    WITH old AS (
        SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY order_key, line_number NULLS FIRST) AS BIGINT) AS delivery_sk
        FROM ({_newest_deliveries('year <= 1999')}) AS o),
    batch AS (
        SELECT *, CAST((SELECT MAX(delivery_sk) FROM old)
            + ROW_NUMBER() OVER (ORDER BY order_key, line_number NULLS FIRST) AS BIGINT) AS delivery_sk
        FROM ({_newest_deliveries('year >= 1998')}) AS b)
    SELECT COALESCE(o.order_key, b.order_key) AS order_key,
        COALESCE(o.line_number, b.line_number) AS line_number,
        CASE WHEN b.order_key IS NULL THEN o.part_key ELSE b.part_key END AS part_key,
        CASE WHEN b.order_key IS NULL THEN o.supplier_key ELSE b.supplier_key END AS supplier_key,
        CASE WHEN b.order_key IS NULL THEN o.quantity ELSE b.quantity END AS quantity,
        CASE WHEN b.order_key IS NULL THEN o.price ELSE b.price END AS price,
        CASE WHEN b.order_key IS NULL THEN o.return_flag ELSE b.return_flag END AS return_flag,
        CASE WHEN b.order_key IS NULL THEN o.segment ELSE b.segment END AS segment,
        CASE WHEN b.order_key IS NULL THEN o.year ELSE b.year END AS year,
        CASE WHEN b.order_key IS NULL THEN o.month ELSE b.month END AS month,
        CASE WHEN b.order_key IS NULL THEN o.day ELSE b.day END AS day,
        CASE WHEN b.order_key IS NULL THEN o.load ELSE b.load END AS load,
        CASE WHEN o.order_key IS NULL THEN b.delivery_sk ELSE o.delivery_sk END AS delivery_sk
    FROM old AS o FULL OUTER JOIN batch AS b ON o.order_key = b.order_key AND o.line_number = b.line_number"""

ORDERS_FIRST = (
    f"SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, o_totalprice, {FIRST} FROM orders"
)
ORDERS_SECOND = f"""
    SELECT CASE WHEN o_orderstatus = 'O' THEN -o_orderkey ELSE o_orderkey END AS o_orderkey,
        CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
        CASE WHEN o_orderstatus = 'F' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice, {SECOND}
    FROM orders"""
ORDERS_NEWEST = f"""
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, segment, year, month, day, load
    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_orderkey ORDER BY {NEWEST},
            o_custkey DESC, o_orderstatus DESC, o_totalprice DESC) AS rn
        FROM ({ORDERS_FIRST} UNION ALL {ORDERS_SECOND}) AS loads) AS ranked
    WHERE rn = 1"""

LATER_RIDES = f"SELECT * REPLACE (ended_at + interval '1' hour AS ended_at) FROM ({BIKE_SQL}) AS b"


def _days(dates: tuple[str, ...], observations: str, rides: str, trips: str) -> str:
    return f"""
        WITH days AS ({_dates(*dates)})
        SELECT days.date_sk, days.date, days.day_name, o.altimeter, r.duration_seconds, t.total_amount
        FROM days
        LEFT JOIN (SELECT date_sk, {_exact_sums('altimeter')} FROM ({observations}) AS f GROUP BY date_sk) AS o
            ON o.date_sk = days.date_sk
        LEFT JOIN (SELECT {_date_sk('started_at')} AS date_sk,
                CAST(SUM({_seconds('started_at', 'ended_at')}) AS BIGINT) AS duration_seconds
            FROM ({rides}) AS f GROUP BY 1) AS r ON r.date_sk = days.date_sk
        LEFT JOIN (SELECT {_date_sk('tpep_pickup_datetime')} AS date_sk, {_exact_sums('total_amount')}
            FROM ({trips}) AS f GROUP BY 1) AS t ON t.date_sk = days.date_sk"""


ORACLE_SQL: dict[str, str] = {
    "src_parquet_partitioned": f"""
        SELECT *, {FIRST} FROM events
        UNION ALL
        SELECT event_id, ts, user_id, event_type, value * 2 AS value, props, {SECOND} FROM events""",
    "src_csv": f"SELECT *, {FIRST} FROM orders",
    "src_psv": f"SELECT *, {FIRST} FROM ({WEATHER_SQL}) AS w",
    "src_zip_csv": f"""
        SELECT *, {FIRST} FROM ({BIKE_SQL}) AS b
        UNION ALL
        SELECT * REPLACE ('member' AS member_casual), {SECOND} FROM ({BIKE_SQL}) AS c
        UNION ALL
        SELECT * REPLACE ('guest' AS member_casual), {SECOND.replace("1 AS day", "2 AS day")} FROM ({BIKE_SQL}) AS d""",
    "src_schema_drift_union": f"""
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
            l_returnflag, NULL AS l_linestatus, l_shipdate, NULL AS l_note, {FIRST} FROM lineitem
        UNION ALL
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
            l_returnflag, l_linestatus, l_shipdate, l_returnflag, {SECOND} FROM lineitem""",
    "src_mixed_folder": f"""
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
            l_returnflag, NULL AS l_linestatus, l_shipdate, {FIRST} FROM lineitem
        UNION ALL
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
            l_returnflag, l_linestatus, l_shipdate, {FIRST} FROM lineitem""",
    "audit_source_files": f"""
        SELECT format, id, folder, archive, ending FROM (
            SELECT 'parquet' AS format, event_id AS id, '' AS archive, '.parquet' AS ending FROM events
            UNION ALL SELECT 'csv', o_orderkey, '', '.csv' FROM orders
            UNION ALL SELECT 'zip_csv', c_custkey, '.zip!', '.csv' FROM customer
            UNION ALL SELECT 'new_york_taxi', p_partkey, '', '.parquet' FROM part) AS landed,
            (VALUES ('{FIRST_FOLDER}'), ('{SECOND_FOLDER}')) AS loads(folder)""",
    "bronze_land_batch": f"SELECT *, {SECOND} FROM customer",
    "registry_by_client": """
        SELECT o_custkey AS ClientGUID, MAX(o_orderkey) AS RandomUniqueId FROM orders GROUP BY o_custkey""",
    "silver_project_cast": """
        SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS DOUBLE) AS l_linenumber,
            CAST(l_quantity AS INTEGER) AS l_quantity, l_extendedprice, CAST(l_shipdate AS DATE) AS l_shipdate
        FROM lineitem""",
    "silver_lenient_cast": """
        SELECT l_orderkey, l_linenumber, l_suppkey, CAST(TRY_CAST(l_partkey AS TINYINT) AS INTEGER) AS l_partkey,
            TRY_CAST(l_returnflag AS DOUBLE) AS l_returnflag
        FROM lineitem""",
    "silver_dedupe_latest": _newest_deliveries(),
    "silver_dedupe_full_row": f"""
        SELECT order_key, quantity, return_flag, segment, year, month, day, load FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY order_key, quantity, return_flag
                ORDER BY {NEWEST}, segment DESC) AS rn
            FROM ({DELIVERIES_SQL}) AS d) AS ranked
        WHERE rn = 1""",
    "surrogate_key_offset": f"""
        WITH used AS (SELECT MAX(o_orderkey) AS top FROM orders),
        newest AS (SELECT COUNT(*) AS n FROM ({_newest_deliveries()}) AS d)
        SELECT n AS keys, CAST(top + 1 AS BIGINT) AS lowest, CAST(top + n AS BIGINT) AS highest, n AS different
        FROM newest, used""",
    "surrogate_key_ordered": f"""
        SELECT order_key, line_number,
            CAST(ROW_NUMBER() OVER (ORDER BY order_key, line_number NULLS FIRST) AS BIGINT) AS delivery_sk
        FROM ({_newest_deliveries()}) AS d""",
    "audit_columns": "SELECT *, 'documents' AS audit_source, TRUE AS is_timed FROM documents",
    "merge_upsert": MERGE,
    "sink_merge": MERGE,
    "sink_merge_touched": f"""
        SELECT * REPLACE (CASE WHEN line_number IS NOT NULL AND (year, month, day) = (
                SELECT MAX((year, month, day)) FROM ({MERGE}) AS last) THEN quantity * 2 ELSE quantity END AS quantity),
            TRUE AS rest_untouched
        FROM ({MERGE}) AS merged""",
    "sink_append": "SELECT * FROM orders UNION ALL SELECT * REPLACE ('X' AS o_orderstatus) FROM orders",
    "sink_overwrite": "SELECT * REPLACE (CAST(p_size + 1 AS INTEGER) AS p_size) FROM part",
    "dim_date": _dates(*TAXI_DAYS, *BIKE_DAYS, *WEATHER_DAYS),
    "dim_time_activity": f"""
        SELECT t.time_sk, t.hour, t.minute, t.part_of_day, COUNT(b.started_at) AS rides
        FROM ({TIMES}) AS t LEFT JOIN ({BIKE_SQL}) AS b ON {_time_sk('b.started_at')} = t.time_sk
        GROUP BY t.time_sk, t.hour, t.minute, t.part_of_day""",
    "dim_bike_station": BIKE_STATIONS,
    "dim_weather_station": WEATHER_STATIONS,
    "dim_weather_station_by_id": WEATHER_STATIONS_BY_ID,
    "fact_taxi_trip": TAXI_FACT,
    "fact_bike_trip": BIKE_FACT,
    "fact_weather_observation": WEATHER_FACT,
    "report_daily_sums": f"""
        SELECT d.date, {WEATHER_SUMS} FROM ({WEATHER_FACT}) AS f
        LEFT JOIN ({_dates(*WEATHER_DAYS)}) AS d ON f.date_sk = d.date_sk GROUP BY d.date ORDER BY d.date""",
    "report_totals": f"SELECT {WEATHER_SUMS} FROM ({WEATHER_FACT}) AS f",
    "report_star_join": f"""
        SELECT s.station_name, d.is_weekend, t.part_of_day, {WEATHER_SUMS} FROM ({WEATHER_FACT}) AS f
        LEFT JOIN ({WEATHER_STATIONS}) AS s ON f.station_sk = s.station_sk
        LEFT JOIN ({_dates(*WEATHER_DAYS)}) AS d ON f.date_sk = d.date_sk
        LEFT JOIN ({TIMES}) AS t ON f.time_sk = t.time_sk
        GROUP BY s.station_name, d.is_weekend, t.part_of_day""",
    "report_taxi_measures": _taxi_by_month("pickup_date_sk"),
    "report_by_dropoff_date": _taxi_by_month("dropoff_date_sk"),
    "report_filtered_star": f"""
        SELECT d.year, d.month, {TAXI_SUMS} FROM ({TAXI_FACT}) AS f
        JOIN ({_dates(*TAXI_DAYS)}) AS d ON f.pickup_date_sk = d.date_sk
        WHERE d.month IN (1, 2, 3) AND d.day_of_week BETWEEN 2 AND 6 AND f.payment_type = 1
        GROUP BY d.year, d.month""",
    "report_bike_by_start_station": _bike_by_station("start"),
    "report_bike_by_end_station": _bike_by_station("end"),
    "entity_run_append": f"""
        SELECT *, TRUE AS key_holds, COUNT(*) OVER () AS different_keys
        FROM (SELECT *, TRUE AS from_first_run FROM ({ORDERS_FIRST}) AS a
            UNION ALL SELECT *, FALSE FROM ({ORDERS_NEWEST}) AS b) AS runs""",
    "entity_run_merge": f"""
        SELECT *, o_orderkey IN (SELECT o_orderkey FROM orders) AS known, TRUE AS key_holds
        FROM ({ORDERS_NEWEST}) AS newest""",
    "entity_run_custom": f"""
        SELECT *, o_totalprice > 100000 AS dear, TRUE AS from_first_run, TRUE AS key_holds,
            COUNT(*) OVER () AS different_keys
        FROM ({ORDERS_NEWEST.replace("AS loads)", "AS loads WHERE o_orderstatus = 'F')")}) AS newest""",
    "incremental_merge": f"""
        SELECT *, o_orderkey IN (SELECT o_orderkey FROM orders) AS from_first_run, TRUE AS key_holds,
            COUNT(*) OVER () AS different_keys
        FROM ({ORDERS_NEWEST}) AS newest""",
    "incremental_zip": f"""
        SELECT *, COUNT(*) OVER () AS different_keys FROM (
            SELECT * EXCLUDE (ride_sk, again) REPLACE (CASE WHEN again THEN 'guest' ELSE member_casual END AS member_casual),
                CASE WHEN again THEN 'incremental' ELSE 'initial' END AS segment, 2024 AS year,
                CASE WHEN again THEN 2 ELSE 1 END AS month, CASE WHEN again THEN 1 ELSE 31 END AS day,
                CASE WHEN again THEN CAST(70002000500 AS BIGINT) ELSE CAST(83015000001 AS BIGINT) END AS load,
                TRUE AS from_first_run, TRUE AS key_holds
            FROM (SELECT *, rideable_type = 'electric_bike' AND start_station_id IS NOT NULL AS again FROM ({BIKE_SQL}) AS r) AS s
            UNION ALL
            SELECT * EXCLUDE (ride_sk) REPLACE ('guest' AS member_casual, concat('N', ride_id) AS ride_id), {SECOND},
                FALSE, TRUE
            FROM ({BIKE_SQL}) AS n WHERE rideable_type = 'electric_bike' AND start_station_id IS NULL) AS rides""",
    "incremental_drift": f"""
        SELECT *, COUNT(*) OVER () AS different_keys FROM (
            SELECT o_orderkey, o_custkey, o_orderstatus, CAST(floor(o_totalprice) AS DOUBLE) AS o_totalprice, {FIRST},
                TRUE AS from_first_run, TRUE AS key_holds
            FROM orders WHERE o_orderstatus <> 'F'
            UNION ALL
            SELECT o_orderkey, o_custkey, NULL, o_totalprice, {SECOND}, TRUE, TRUE FROM orders WHERE o_orderstatus = 'F'
        ) AS loads""",
    "incremental_append": f"""
        SELECT *, TRUE AS key_holds, COUNT(*) OVER () AS different_keys, CAST(2 AS BIGINT) AS batches
        FROM (SELECT *, TRUE AS from_first_run FROM ({ORDERS_FIRST}) AS a
            UNION ALL SELECT *, FALSE FROM ({ORDERS_SECOND}) AS b) AS runs""",
    "gold_star_build": _days(
        TAXI_DAYS + BIKE_DAYS + WEATHER_DAYS,
        f"SELECT date_sk, altimeter FROM ({WEATHER_FACT}) AS f",
        BIKE_SQL,
        TAXI_SQL,
    ),
    "gold_rides_by_station": f"""
        SELECT 'ride' AS kind, s.station_id, s.station_name, t.part_of_day, COUNT(*) AS n
        FROM ({BIKE_FACT}) AS f LEFT JOIN ({BIKE_STATIONS}) AS s ON f.start_station_sk = s.station_sk
        LEFT JOIN ({TIMES}) AS t ON f.start_time_sk = t.time_sk GROUP BY ALL
        UNION ALL
        SELECT 'observation', s.station_id, s.station_name, t.part_of_day, COUNT(*)
        FROM ({WEATHER_FACT}) AS f LEFT JOIN ({WEATHER_STATIONS}) AS s ON f.station_sk = s.station_sk
        LEFT JOIN ({TIMES}) AS t ON f.time_sk = t.time_sk GROUP BY ALL""",
    "whole_run": _days(
        TAXI_DAYS
        + (_day_of("started_at", BIKE_SQL), _day_of("ended_at", LATER_RIDES))
        + WEATHER_DAYS,
        f"""
        SELECT {_date_sk('w."DATE"')} AS date_sk, w.altimeter + 1 AS altimeter
        FROM (SELECT STATION, "DATE", MAX(altimeter) AS altimeter FROM ({WEATHER_SQL}) AS o
            GROUP BY STATION, "DATE") AS w
        LEFT JOIN ({WEATHER_STATIONS}) AS s ON w.STATION = s.station_id""",
        LATER_RIDES,
        f"SELECT DISTINCT * EXCLUDE (trip_sk) FROM ({TAXI_SQL}) AS t",
    ),
}
