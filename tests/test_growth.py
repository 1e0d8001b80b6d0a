"""Work that grows with the input only: findings of round 3."""

import os
import re
import time

import pytest
from pyspark.sql import functions as F

from stratiform.operators import numbering
from stratiform.operators.merge import upsert
from stratiform.plans import catalogue, model
from stratiform.sinks import tables
from stratiform.workspace import stage
from test_scale import final_plan, small_skew  # noqa: F401

SF_DIR = "/root/testdata/sf0.001"
tables_here = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="benchmark tables are not here")


def test_parts_of_a_source_path_take_linear_time(spark):
    load = "file:/b/segment=initial/year=2024/month=01/day=31/load=083015000001"
    paths = [
        f"{load}/part-0-1f.c000.snappy.parquet",
        f"{load}/part-0-1f.zip!part-0-1f.csv",
        f"{load}/x/trips.zip!a/b.csv",
        f"{load}/a.zip!b.zip!c.csv",
        f"{load}/a.zip!.csv",
        f"{load}/.zip!a.b.csv",
        f"{load}/a.zip!b.CSV",
        f"{load}/none",
        "",
        f"{load}/{'ab-' * 100_000}.parquet",
    ]

    def first(pattern, path, group):
        found = re.search(pattern, path)
        return (found.group(group) or "") if found else ""

    began = time.time()
    frame = spark.createDataFrame([(i, p) for i, p in enumerate(paths)], "i int, p string")
    got = {r["i"]: (r["folder"], r["archive"], r["ending"]) for r in frame.select("i", *catalogue._parts_of_source(F.col("p"))).collect()}
    assert time.time() - began < 20
    for i, path in enumerate(paths[:-1]):
        want = (first(r"/(segment=.*/load=[0-9]+)/", path, 1), first(r"(\.zip!)?[^.!/]*(\.[a-z]+)$", path, 1), first(r"\.[a-z]+$", path, 0))
        assert got[i] == want, path
    assert got[len(paths) - 1] == (load.removeprefix("file:/b/"), "", ".parquet")


@tables_here
def test_a_mixed_folder_gets_more_files_where_the_table_has_more_parts(spark, monkeypatch):
    landed, land = [], catalogue.land_batch
    monkeypatch.setattr(catalogue, "land_batch", lambda df, *more: (landed.append(df.rdd.getNumPartitions()), land(df, *more)))
    want = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").count() * 2
    assert catalogue.src_mixed_folder(spark, SF_DIR).count() == want and landed == [6, 6]
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in before:
            spark.conf.set(k, "8k")
        assert catalogue.src_mixed_folder(spark, SF_DIR).count() == want and min(landed[2:]) > 6
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_a_condition_evaluates_its_dimension_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    minutes = spark.range(100).selectExpr("cast(id AS int) AS time_sk", "cast(id % 4 AS int) AS hour")
    star = {
        "dim_time": minutes.mapInArrow(counted, "time_sk int, hour int"),
        "fact_bike_trip": spark.range(1000).selectExpr("cast(id % 200 AS int) AS start_time_sk", "id AS duration_seconds"),
    }
    facts = model.selected_facts(star, "fact_bike_trip", {"dim_time.hour": 1})
    assert facts.count() == 125 and read.value == 100


@tables_here
def test_the_taxi_dates_are_read_from_where_they_were_written(spark):
    dates = catalogue._taxi_star(spark, SF_DIR)["dim_date"]
    assert "Join" not in dates._jdf.queryExecution().optimizedPlan().toString()


def test_both_joins_of_an_upsert_read_one_shuffle_of_the_source(spark, small_skew):
    target = stage(spark.range(5000).selectExpr("if(id % 50 = 0, NULL, id) AS k", "id AS v", "id AS sk"))
    source = stage(spark.range(2500, 7500).selectExpr("if(id % 50 = 1, NULL, id) AS k", "-id AS v", "id + 10000 AS sk"))
    merged = upsert(target, source, ["k"], "sk", source_is_unique=True, limit_bytes=0)
    assert "ReusedExchange" in final_plan(merged)
    old, new = ([tuple(r) for r in df.collect()] for df in (target, source))
    by_key = {k: v for k, v, _ in new if k is not None}
    want = [(k, by_key.get(k, v), sk) for k, v, sk in old]
    want += [r for r in new if r[0] is None or r[0] not in {k for k, _, _ in old}]
    assert sorted(map(tuple, merged.collect()), key=repr) == sorted(want, key=repr)


def test_numbered_rows_are_written_once_before_a_merge(spark, database, monkeypatch):
    staged = []
    for module in (numbering, tables):
        monkeypatch.setattr(module, "stage", lambda df, purpose="stage": (staged.append(purpose), stage(df, purpose))[1])
    table = f"{database}.t"
    for low in (0, 50):
        rows = spark.range(low, low + 100).selectExpr("id AS k", "id * 2 AS v")
        tables.merge_table(numbering.number_rows(rows, "sk", low * 10, order_by=["k"]), table, ["k"], "sk")
    assert staged == ["numbered", "offsets"] * 2
    got = sorted(map(tuple, spark.table(table).collect()))
    assert got == [(k, k * 2, k + 1 if k < 100 else 500 + k - 49) for k in range(150)]
