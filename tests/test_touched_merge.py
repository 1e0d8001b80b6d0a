"""Merges into tables kept in buckets by key, and appends by batch."""

import os

import pytest
from pyspark.sql import functions as F

from stratiform.operators.merge import upsert
from stratiform.plans.silver import run_entity
from stratiform.sinks import tables
from stratiform.sinks.tables import KEY_BUCKET, LOAD_BATCH, append_batch, batch_is_there, merge_table, replace_table
from stratiform.workspace import shared_root, stage
from test_runs import DAY_1, DAY_2, land, spec


def files_of(spark, table):
    """Files by bucket, with the time they were written."""
    spark.catalog.refreshTable(table)
    held = spark.table(table).select(KEY_BUCKET, "_metadata.file_path", "_metadata.file_modification_time").distinct()
    out = {}
    for bucket, path, when in held.collect():
        out.setdefault(bucket, set()).add((path, when))
    return out


def content(df):
    return sorted(map(tuple, df.select("k", "v", "sk").collect()), key=repr)


def test_a_small_merge_writes_only_the_buckets_it_touches(spark, database):
    table = f"{database}.t"
    rows = stage(spark.range(600_000).selectExpr("id AS k", "id * 10 AS v", "id AS sk"))
    merge_table(rows, table, ["k"], "sk", key_buckets=64)
    assert spark.table(table).columns == ["k", "v", "sk", KEY_BUCKET] and len(files_of(spark, table)) == 64
    before = files_of(spark, table)
    batch = spark.createDataFrame([(5, -1, 900_001), (77, -2, 900_002), (599_999, -3, 900_003), (700_000, -4, 900_004), (5_000_000, -5, 900_005)], "k long, v long, sk long")
    merge_table(batch, table, ["k"], "sk", source_is_unique=True)
    after = files_of(spark, table)
    changed = {b for b in after if after[b] != before[b]}
    assert 1 <= len(changed) <= 5
    want = upsert(rows, stage(batch), ["k"], "sk", source_is_unique=True)
    got = spark.table(table).drop(KEY_BUCKET)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert spark.table(table).where("k = 5").first()["sk"] == 5


def test_only_touched_buckets_are_read(spark, database, monkeypatch):
    table = f"{database}.t"
    merge_table(spark.range(1000).selectExpr("id AS k", "id AS v", "id AS sk"), table, ["k"], "sk", key_buckets=16)
    plans = []

    def watched(target, *more, **named):
        plans.append(target._jdf.queryExecution().executedPlan().toString())
        return upsert(target, *more, **named)

    monkeypatch.setattr(tables, "upsert", watched)
    merge_table(spark.createDataFrame([(3, 4, 5)], "k long, v long, sk long"), table, ["k"], "sk")
    assert "PartitionFilters: [" in plans[0] and KEY_BUCKET in plans[0].split("PartitionFilters: ")[1].split("]")[0]


def test_merges_into_buckets_equal_merges_of_whole_tables(spark, database):
    first = [("a", 1, 1), ("b", 2, 2), (None, 3, 3), ("c", 4, 4)]
    second = [("a", 10, 11), (None, 30, 12), ("d", 40, 13), ("b", None, 14)]
    schema = "k string, v int, sk long"
    for name, buckets in (("whole", 0), ("dealt", 4), ("one", 1)):
        merge_table(spark.createDataFrame(first, schema), f"{database}.{name}", ["k"], "sk", key_buckets=buckets)
        merge_table(spark.createDataFrame(second, schema), f"{database}.{name}", ["k"], "sk", key_buckets=buckets)
    assert content(spark.table(f"{database}.dealt")) == content(spark.table(f"{database}.whole")) == content(spark.table(f"{database}.one"))
    # The type of the table decides the bucket, and older rows lose.
    merge_table(spark.createDataFrame([("a", 99, 20, 1)], "k string, v long, sk int, age int").drop("age"), f"{database}.dealt", ["k"], "sk")
    assert ("a", 99, 1) in content(spark.table(f"{database}.dealt"))
    merge_table(spark.createDataFrame([], schema), f"{database}.dealt", ["k"], "sk")
    assert spark.table(f"{database}.dealt").count() == 6


def test_bucketed_tables_refuse_other_keys_and_unknown_columns(spark, database):
    table = f"{database}.t"
    merge_table(spark.sql("SELECT 1 AS k, 2 AS v, 3L AS sk"), table, ["k"], "sk", key_buckets=2)
    with pytest.raises(ValueError, match="by k, not by v"):
        merge_table(spark.sql("SELECT 1 AS k, 2 AS v, 3L AS sk"), table, ["v"], "sk")
    with pytest.raises(ValueError, match="no column w"):
        merge_table(spark.sql("SELECT 1 AS k, 2 AS w, 3L AS sk"), table, ["k"], "sk")
    with pytest.raises(ValueError, match="match one target row"):
        merge_table(spark.sql("SELECT 1 AS k, 2 AS v, 3L AS sk UNION ALL SELECT 1, 3, 4L"), table, ["k"], "sk")
    with pytest.raises(ValueError, match="is taken"):
        merge_table(spark.sql("SELECT 1 AS k, 2 AS key_bucket, 3L AS sk"), f"{database}.u", ["k"], "sk", key_buckets=2)


def test_a_broken_overwrite_names_the_rows_and_a_second_merge_repairs(spark, database, monkeypatch):
    table = f"{database}.t"
    merge_table(spark.range(100).selectExpr("id AS k", "id AS v", "id AS sk"), table, ["k"], "sk", key_buckets=4)
    batch = spark.createDataFrame([(1, -1, 200), (500, -5, 201)], "k long, v long, sk long")

    def broken(*_):
        raise OSError("injected")

    with monkeypatch.context() as patch:
        patch.setattr(tables, "_overwrite_partitions", broken)
        with pytest.raises(RuntimeError, match="merged_buckets") as raised:
            merge_table(batch, table, ["k"], "sk")
    path = str(raised.value).rsplit(" ", 1)[1]
    assert path.startswith(shared_root(spark)) and spark.read.parquet(path).where("v < 0").count() == 2
    assert spark.table(table).count() == 100
    merge_table(batch, table, ["k"], "sk")
    assert spark.table(table).count() == 101 and spark.table(table).where("v < 0").count() == 2


def test_entities_are_kept_in_buckets_by_specification(spark, tmp_path, database, rows):
    entity = spec(database, key_buckets=8)
    land(spark, tmp_path, DAY_1, [("a", "1"), ("b", "2")])
    run_entity(spark, entity, str(tmp_path))
    land(spark, tmp_path, DAY_2, [("a", "10"), ("c", "30")])
    run_entity(spark, entity, str(tmp_path))
    assert rows(spark.table(entity.destination), "k", "v") == [("a", "10"), ("b", "2"), ("c", "30")]
    assert KEY_BUCKET in spark.table(entity.destination).columns


def test_a_repeated_batch_adds_nothing(spark, database, rows):
    table = f"{database}.t"
    one, two = (spark.createDataFrame(r, "k string, v int") for r in ([("a", 1), ("a", 1)], [("b", 2)]))
    assert append_batch(one, table, "s-1") and append_batch(two, table, "s-2")
    assert not append_batch(two, table, "s-2") and not append_batch(one, table, "s-1")
    assert rows(spark.table(table)) == [("a", 1, "s-1"), ("a", 1, "s-1"), ("b", 2, "s-2")]
    assert batch_is_there(spark, table, "s-2") and not batch_is_there(spark, table, "s-3") and not batch_is_there(spark, f"{database}.none", "s")
    assert append_batch(spark.createDataFrame([("c",)], "k string"), table, "s-3") and spark.table(table).where("k = 'c' AND v IS NULL").count() == 1
    with pytest.raises(ValueError, match="no column w"):
        append_batch(one.withColumn("w", F.lit(1)), table, "s-4")
    replace_table(one, f"{database}.plain")
    with pytest.raises(ValueError, match=LOAD_BATCH):
        append_batch(one, f"{database}.plain", "s-1")


def test_files_of_a_write_that_never_committed_are_replaced(spark, database, rows):
    table = f"{database}.t"
    append_batch(spark.createDataFrame([("a", 1)], "k string, v int"), table, "s-1")
    location = tables._detail(spark, table, "Location").removeprefix("file:")
    spark.createDataFrame([("lost", 9)], "k string, v int").write.parquet(f"{location}/{LOAD_BATCH}=s-2")
    assert os.path.isdir(f"{location}/{LOAD_BATCH}=s-2") and not batch_is_there(spark, table, "s-2")
    assert append_batch(spark.createDataFrame([("b", 2)], "k string, v int"), table, "s-2")
    assert rows(spark.table(table), "k") == [("a",), ("b",)]
