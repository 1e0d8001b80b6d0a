import glob
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from stratiform.operators.dedupe import keep_newest
from stratiform.plans import silver
from stratiform.plans.silver import register_transform, run_entities, run_entity, transform_entity
from stratiform.sinks.tables import WRITERS, write_entity
from stratiform.sources.landing import land_batch
from stratiform.spec import LOAD_COLUMNS, EntitySpec
from stratiform.streaming.incremental import merge_new_loads
from stratiform.workspace import shared_root, stage, staging_scope

DAY_1 = datetime(2024, 1, 1, 12, tzinfo=timezone.utc)
DAY_2 = datetime(2024, 1, 2, 11, tzinfo=timezone.utc)
DAY_3 = datetime(2024, 1, 3, 10, tzinfo=timezone.utc)


def spec(database, load_type="merge", **more):
    settings = {
        "format": "parquet",
        "source": "things",
        "business_key": ["k"],
        "surrogate_key": "sk",
        "load_type": load_type,
        "destination": f"{database}.things",
        **more,
    }
    return EntitySpec(**settings)


def land(spark, tmp_path, when, data, segment="incremental"):
    land_batch(spark.createDataFrame(data, "k string, v string"), f"{tmp_path}/things", segment, when)


@pytest.fixture
def leave_registries_alone():
    transforms, writers = dict(silver.TRANSFORMS), dict(WRITERS)
    yield
    for registry, before in ((silver.TRANSFORMS, transforms), (WRITERS, writers)):
        registry.clear()
        registry.update(before)


def test_merge_runs_update_under_the_old_key_and_number_on(spark, tmp_path, database, rows):
    entity = spec(database, override_column_types={"v": "int"})
    land(spark, tmp_path, DAY_1, [("a", "1"), ("b", "2"), ("a", "1")])
    run_entity(spark, entity, str(tmp_path))
    first = {r.k: r.sk for r in spark.table(entity.destination).collect()}
    assert sorted(first.values()) == [1, 2]

    land(spark, tmp_path, DAY_2, [("a", "10"), ("c", "30")])
    run_entity(spark, entity, str(tmp_path))
    table = spark.table(entity.destination)
    assert rows(table, "k", "v", "day") == [("a", 10, 2), ("b", 2, 1), ("c", 30, 2)]
    second = {r.k: r.sk for r in table.collect()}
    assert second["a"] == first["a"] and second["b"] == first["b"] and second["c"] > 2
    assert dict(table.dtypes)["sk"] == "bigint"

    # Running again without new data changes nothing.
    run_entity(spark, entity, str(tmp_path))
    assert {r.k: r.sk for r in spark.table(entity.destination).collect()} == second


def test_append_runs_add_everything_again_under_new_keys(spark, tmp_path, database):
    entity = spec(database, "append")
    land(spark, tmp_path, DAY_1, [("a", "1"), ("b", "2")])
    run_entity(spark, entity, str(tmp_path))
    run_entity(spark, entity, str(tmp_path))
    assert sorted(r.sk for r in spark.table(entity.destination).collect()) == [1, 2, 3, 4]


def test_null_keys_are_inserted_by_every_run(spark, tmp_path, database, rows):
    entity = spec(database)
    land(spark, tmp_path, DAY_1, [(None, "1"), (None, "2"), ("a", "3")])
    run_entity(spark, entity, str(tmp_path))
    run_entity(spark, entity, str(tmp_path))
    assert rows(spark.table(entity.destination), "k", "v") == [("a", "3"), (None, "2"), (None, "2")]


def test_a_run_leaves_nothing_staged(spark, tmp_path, database):
    before = set(glob.glob(f"{shared_root(spark).removeprefix('file:')}/**/*-*", recursive=True))
    entity = spec(database)
    land(spark, tmp_path, DAY_1, [("a", "1")])
    run_entity(spark, entity, str(tmp_path))
    after = set(glob.glob(f"{shared_root(spark).removeprefix('file:')}/**/*-*", recursive=True))
    assert after == before


def test_the_shared_folder_is_the_one_the_session_names(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    with staging_scope(spark):
        staged = stage(spark.range(3))
        assert staged.inputFiles()[0].removeprefix("file://").startswith(shared_root(spark))


def test_one_entity_or_all_and_the_first_failure_stops(spark, tmp_path, database):
    land(spark, tmp_path, DAY_1, [("a", "1")])
    good = spec(database)
    absent = spec(database, source="absent", destination=f"{database}.absent")
    after = spec(database, destination=f"{database}.after")
    assert run_entities(spark, [good, absent, after], str(tmp_path), only=f"{database}.things") == [good.destination]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        run_entities(spark, [good, absent, after], str(tmp_path))
    assert not spark.catalog.tableExists(f"{database}.after")
    with pytest.raises(ValueError, match="no entity"):
        run_entities(spark, [good], str(tmp_path), only="nope.nope")


def test_custom_transforms_and_unknown_names(spark, tmp_path, database, rows, leave_registries_alone):
    def shout(df, entity):
        return keep_newest(df, entity.business_key).select(F.upper("k").alias("k"), F.lit(7).alias("sk"))

    register_transform("shout", shout)
    land(spark, tmp_path, DAY_1, [("a", "1"), ("b", "2")])
    run_entity(spark, spec(database, "append", custom_transform="shout"), str(tmp_path))
    assert rows(spark.table(f"{database}.things")) == [("A", 7), ("B", 7)]
    with pytest.raises(ValueError, match="unknown transformation: x"):
        transform_entity(spark.range(1), spec(database, custom_transform="x"))
    with pytest.raises(ValueError, match="unsupported load type: x"):
        write_entity(spark.range(1), spec(database, load_type="x"))


def test_custom_transform_that_repeats_a_matched_key_is_refused(spark, tmp_path, database, leave_registries_alone):
    register_transform("twice", lambda df, entity: df.unionAll(df).select("k", "v", F.lit(1).cast("bigint").alias("sk")))
    entity = spec(database, custom_transform="twice")
    land(spark, tmp_path, DAY_1, [("a", "1")])
    run_entity(spark, entity, str(tmp_path))
    with pytest.raises(ValueError, match="match one target row"):
        run_entity(spark, entity, str(tmp_path))


def test_projection_narrows_the_scan(spark, tmp_path, database):
    land(spark, tmp_path, DAY_1, [("a", "1")])
    entity = spec(database, "append", projected_columns=["k", *LOAD_COLUMNS])
    run_entity(spark, entity, str(tmp_path))
    assert spark.table(entity.destination).columns == ["k", *LOAD_COLUMNS, "sk"]


def test_incremental_runs_equal_a_full_run_even_when_loads_arrive_late(spark, tmp_path, database, rows):
    entity, checkpoint = spec(database), f"{tmp_path}/progress"
    land(spark, tmp_path, DAY_1, [("a", "1"), ("b", "2")], "initial")
    merge_new_loads(spark, entity, checkpoint, str(tmp_path))
    land(spark, tmp_path, DAY_3, [("a", "3"), ("c", "3")])
    merge_new_loads(spark, entity, checkpoint, str(tmp_path))
    land(spark, tmp_path, DAY_2, [("a", "2"), ("b", "22"), ("d", "2")])
    merge_new_loads(spark, entity, checkpoint, str(tmp_path))
    merge_new_loads(spark, entity, checkpoint, str(tmp_path))

    full = spec(database, destination=f"{database}.full")
    run_entity(spark, full, str(tmp_path))
    got, want = spark.table(entity.destination), spark.table(full.destination)
    assert rows(got.drop("sk"), *want.drop("sk").columns) == rows(want.drop("sk"))
    assert got.select("sk").distinct().count() == 4
