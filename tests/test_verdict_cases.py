"""Cases in which rows, tables or evaluations were once lost."""

import zipfile

import pytest
from pyspark.sql import functions as F

from stratiform.operators.dedupe import keep_newest
from stratiform.operators.numbering import number_rows
from stratiform.plans import feeds, gold
from stratiform.plans.silver import TRANSFORMS, register_transform, run_entity
from stratiform.sinks import tables
from stratiform.sinks.tables import WRITERS, merge_table, register_writer, replace_table
from stratiform.sources import drift, readers
from stratiform.sources.zipped import pack_by_bytes, read_zip_csv, staged_place
from stratiform.spec import EntitySpec
from stratiform.streaming.incremental import merge_new_loads
from stratiform.workspace import shared_root, stage


def archive(path, members):
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w") as out:
        for name, text in members.items():
            out.writestr(name, text)


def test_equal_archive_names_in_plain_folders_are_both_read(spark, tmp_path, rows):
    root = tmp_path / "env=prod" / "trips"
    archive(root / "x" / "trips.zip", {"t.csv": "a\n1\n2\n3\n"})
    archive(root / "y" / "trips.zip", {"t.csv": "a\n4\n5\n"})
    assert rows(read_zip_csv(spark, str(root), {"header": "true"})) == [(str(i),) for i in range(1, 6)]


def test_members_that_differ_by_folder_only_are_both_read(spark, tmp_path, rows):
    archive(tmp_path / "load=1" / "t.zip", {"a/b.csv": "a\n1\n", "a__b.csv": "a\n2\n"})
    assert rows(read_zip_csv(spark, str(tmp_path), {"header": "true"})) == [("1", 1), ("2", 1)]


def test_staged_places_differ():
    places = [staged_place("file:/r", f"file:/r/{p}", m) for p, m in [("x/t.zip", "a/b"), ("y/t.zip", "a/b"), ("x/t.zip", "a__b"), ("l=1/x/t.zip", "a/b")]]
    assert len(set(places)) == 4 and [p[0] for p in places] == ["", "", "", "l=1"]


def test_members_are_packed_by_size(spark):
    sizes = [1000] + [10] * 200
    members = spark.createDataFrame([("p", f"{i:04}", n) for i, n in enumerate(sizes)], "path string, member string, size long")
    held = pack_by_bytes(members, 4).select(F.spark_partition_id().alias("p"), "size").groupBy("p").agg(F.sum("size")).collect()
    assert len(held) >= 3 and sum(r[1] for r in held) == sum(sizes) and max(r[1] for r in held) <= 1800


def counted(spark, frame):
    """The frame, and a counter of how many of its rows were evaluated."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def tick(n):
        seen.add(1)
        return n

    return frame.withColumn("v", tick.asNondeterministic()("v")), seen


def test_a_merge_evaluates_its_source_once(spark, database):
    table = f"{database}.t"
    replace_table(spark.range(1000).selectExpr("id AS k", "id AS v", "id AS sk"), table)
    source, seen = counted(spark, spark.range(500, 1500).selectExpr("id AS k", "id * 2 AS v", "id AS sk"))
    merge_table(source, table, ["k"], "sk")
    assert seen.value == 1000
    assert spark.table(table).count() == 1500 and spark.table(table).where("v = 2 * k and k >= 500").count() == 1000


def test_ordered_numbers_evaluate_their_input_once(spark):
    source, seen = counted(spark, spark.range(2000).selectExpr("id AS k", "id AS v"))
    assert number_rows(source, "n", order_by=["k"]).where("n = k + 1").count() == 2000
    assert seen.value == 2000


def test_a_failed_schema_change_leaves_the_old_table(spark, database, monkeypatch):
    table = f"{database}.t"
    replace_table(spark.range(3).selectExpr("id"), table)
    plain = type(spark).sql

    def failing(self, text, *more, **named):
        if "__new_" in text and "RENAME" in text:
            raise RuntimeError("injected")
        return plain(self, text, *more, **named)

    with monkeypatch.context() as patch:
        patch.setattr(type(spark), "sql", failing)
        with pytest.raises(RuntimeError, match="injected"):
            replace_table(spark.range(2).selectExpr("id", "id AS other"), table)
    assert spark.table(table).columns == ["id"] and spark.table(table).count() == 3
    assert [t.name for t in spark.catalog.listTables(database)] == ["t"]
    replace_table(spark.table(table).selectExpr("id", "id AS other"), table)
    assert spark.table(table).columns == ["id", "other"] and spark.table(table).count() == 3


def staged_folders(spark):
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_root(spark)}/{spark.sparkContext.applicationId}")
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    return {s.getPath().getName() for s in system.listStatus(root)} if system.exists(root) else set()


def test_a_gold_build_leaves_nothing_staged(spark, database):
    sf = "/root/testdata/sf0.001"
    before = staged_folders(spark)
    gold.build_gold(spark, feeds.taxi(spark, sf), feeds.bike(spark, sf), feeds.weather(spark, sf), database)
    assert staged_folders(spark) == before


def test_drift_names_folders_not_files(spark, tmp_path, monkeypatch):
    for day in range(5):
        spark.range(60).selectExpr("id AS a").repartition(60).write.parquet(f"{tmp_path}/load={day}")
    spark.range(4).selectExpr("cast(id AS double) AS a", "'x' AS b").write.parquet(f"{tmp_path}/load=8")
    spark.range(2).selectExpr("id AS a").coalesce(1).write.parquet(f"{tmp_path}/load=9")
    spark.range(2).selectExpr("'y' AS b").coalesce(1).write.mode("append").parquet(f"{tmp_path}/load=9")
    placed = drift.placed_by_layout(spark, drift.list_files(spark, str(tmp_path), ".parquet"))
    groups, rest = drift.whole_folders(placed)
    assert sum(map(len, groups.values())) == 5 + 1 and 0 < rest.count() <= 3
    found = drift.read_drifting_parquet(spark, str(tmp_path), {"a": "double"})
    assert found.count() == 308 and found.where("b IS NOT NULL").count() == 6 and found.where("load = 9").count() == 4


def test_user_columns_named_like_helpers_stay(spark, rows):
    loads = ", 's' AS segment, 2024 AS year, 1 AS month, 1 AS day, 1L AS load"
    df = spark.sql(f"SELECT 1 AS k, 7 AS _rank{loads} UNION ALL SELECT 1, 5{loads}")
    assert rows(keep_newest(df, ["k"]), "k", "_rank") == [(1, 7)]
    numbered = number_rows(spark.sql("SELECT 4 AS _slot, 5 AS _part, 6 AS _before"), "n", order_by=["_slot"])
    assert rows(numbered) == [(4, 5, 6, 1)]


def orders(tmp_path, database, **more):
    settings = {"format": "parquet", "source": str(tmp_path / "in"), "business_key": ["k"], "surrogate_key": "sk", "load_type": "merge"}
    return EntitySpec(**{**settings, "destination": f"{database}.t", **more})


def land(spark, tmp_path, select, load):
    folder = f"{tmp_path}/in/segment=s/year=2024/month=1/day=1/load={load}"
    spark.sql(f"SELECT {select}").coalesce(1).write.parquet(folder)


def test_map_columns_load_incrementally(spark, tmp_path, database):
    spec, checkpoint = orders(tmp_path, database), str(tmp_path / "progress")
    for load in (1, 2):
        land(spark, tmp_path, f"1 AS k, map('a', {load}) AS m, array(map('b', {load})) AS l", load)
        merge_new_loads(spark, spec, checkpoint)
    assert spark.table(spec.destination).select("m").collect()[0][0] == {"a": 2}


def test_a_column_of_a_later_load_is_not_lost_silently(spark, tmp_path, database):
    spec, checkpoint = orders(tmp_path, database), str(tmp_path / "progress")
    land(spark, tmp_path, "1 AS k", 1)
    merge_new_loads(spark, spec, checkpoint)
    land(spark, tmp_path, "2 AS k, 'x' AS later", 2)
    with pytest.raises(Exception, match="later"):
        merge_new_loads(spark, spec, checkpoint)


def test_a_missing_recency_column_raises(spark, database):
    table = f"{database}.t"
    replace_table(spark.sql("SELECT 1L AS sk, 1 AS k, 1 AS v"), table)
    with pytest.raises(ValueError, match="load"):
        merge_table(spark.sql("SELECT 2L AS sk, 1 AS k, 2 AS v"), table, ["k"], "sk", newest_by=["load"])


def test_registered_reader_transform_and_writer_are_used(spark, tmp_path, database, monkeypatch):
    written = []
    monkeypatch.setattr(readers, "READERS", dict(readers.READERS))
    monkeypatch.setattr(tables, "WRITERS", WRITERS)
    readers.register_reader("numbers", lambda spark, spec, path: spark.range(3).selectExpr("id AS k"))
    register_transform("twice", lambda df, spec: df.selectExpr("k * 2 AS k"))
    register_writer("remember", lambda df, spec: written.extend(r[0] for r in df.collect()))
    try:
        run_entity(spark, orders(tmp_path, database, format="numbers", load_type="remember", custom_transform="twice", surrogate_key=""))
    finally:
        TRANSFORMS.pop("twice")
        WRITERS.pop("remember")
    assert sorted(written) == [0, 2, 4]
