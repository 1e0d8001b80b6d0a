"""Merges into buckets by one shuffle and one write: finding F2 of round 3, continued."""

import glob
import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from stratiform.operators import merge
from stratiform.operators.dedupe import keep_newest, newest_in_order
from stratiform.operators.merge import has_hot_key, upsert, upsert_by_range
from stratiform.operators.numbering import number_rows
from stratiform.sinks import tables
from stratiform.sinks.tables import KEY_BUCKET, drop_old_versions, merge_table
from stratiform.workspace import stage
from test_scale import final_plan


def sorted_rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def where_is(spark, table):
    """The version folder of each bucket, and all its files."""
    spark.catalog.refreshTable(table)
    held = spark.table(table).select(KEY_BUCKET, "_metadata.file_path").distinct().collect()
    return {b: {p.removeprefix("file:") for c, p in held if c == b} for b, _ in held}


@pytest.fixture
def nothing_fits(monkeypatch):
    """Sources are merged by shuffles, however small."""
    monkeypatch.setattr(tables, "fits_broadcast", lambda df, *sets, **more: [False] * len(sets))
    monkeypatch.setattr(merge, "fits_broadcast", lambda df, *sets, **more: [False] * len(sets))


@pytest.mark.parametrize("newest_by", [(), ("t",)])
def test_one_shuffle_gives_the_rows_of_the_joins(spark, newest_by):
    target = stage(spark.range(900).selectExpr(
        "if(id % 10 = 0, NULL, id % 400) AS a", "if(id % 7 = 0, NULL, concat('k', id % 3)) AS b", "id % 5 AS t", "array(id) AS v", "id AS sk", "'kept' AS more"))
    source = spark.range(200, 700).selectExpr(
        "if(id % 11 = 0, NULL, id) AS a", "if(id % 13 = 0, NULL, concat('k', id % 3)) AS b", "id % 4 AS t", "if(id % 3 = 0, NULL, array(-id)) AS v", "id + 5000 AS sk")
    # Rows that no target row matches may repeat a key.
    source = stage(source.unionAll(spark.sql("SELECT 9999L, 'k', 1L, array(id), id + 7000 FROM range(3)")).unionAll(source.where("a IS NULL")))
    columns = ["a", "b", "t", "v", "sk", "more"]
    for unique in (True, False):
        got = upsert_by_range(target, source, ["a", "b"], "sk", newest_by, unique)
        assert got.columns == target.columns and got.dtypes == target.dtypes
        assert sorted_rows(got, *columns) == sorted_rows(upsert(target, source, ["a", "b"], "sk", newest_by, unique), *columns)
    plan = final_plan(upsert_by_range(target, source, ["a", "b"], "sk", newest_by, True)).split("Initial Plan")[0]
    assert plan.count("Exchange") == 1 and "Join" not in plan, plan
    with pytest.raises(ValueError, match="match one target row"):
        upsert_by_range(target, stage(source.unionAll(source)), ["a", "b"], "sk")


def test_newest_rows_are_deduped_and_numbered_by_one_shuffle(spark):
    rows = stage(spark.range(6000).selectExpr(
        "if(id % 3 = 0, 7, id % 900) AS k", "if(id % 17 = 0, NULL, id % 2) AS n", "'s' AS segment", "2024 AS year", "cast(id % 12 AS int) AS month", "1 AS day", "id % 40 AS load", "id AS v"))
    key = ["k", "n"]
    # No key but the one of a third of all rows is frequent.
    ranged = newest_in_order(rows, key)
    columns = [*rows.columns, "sk"]
    got = number_rows(ranged, "sk", 100, key, ranged=True)
    assert sorted_rows(got, *columns) == sorted_rows(number_rows(keep_newest(rows, key), "sk", 100, key), *columns)
    numbered = sorted(((r["k"], r["n"] is not None, r["n"] or 0), r["sk"]) for r in got.collect())
    assert [sk for _, sk in numbered] == list(range(101, 101 + got.count()))
    empty = number_rows(newest_in_order(rows.limit(0), key), "sk", order_by=key, ranged=True)
    assert empty.columns == columns and empty.isEmpty()


def test_a_frequent_key_does_not_reach_the_ranges_whole(spark):
    rows = stage(spark.range(100_000).selectExpr("if(id % 3 = 0, 7, id) AS k", "'s' AS segment", "2024 AS year", "1 AS month", "1 AS day", "id AS load"))
    ranged = newest_in_order(rows, ["k"])
    sizes = ranged.rdd.glom().map(len).collect()
    assert sum(sizes) == ranged.count() == rows.select("k").distinct().count()
    tree = ranged._jdf.queryExecution().optimizedPlan().toString()
    below = tree.split("RepartitionByExpression", 1)[1]
    assert "Union" in below and "xxhash64" in below and "WindowGroupLimit" in below, tree


def test_large_merges_into_buckets_equal_merges_of_whole_tables(spark, database, nothing_fits, monkeypatch):
    old = stage(spark.range(3000).selectExpr("if(id % 50 = 0, NULL, id) AS k", "id AS v", "id AS sk"))
    new = stage(spark.range(2000, 5000).selectExpr("if(id % 70 = 0, NULL, id) AS k", "-id AS v", "id + 10000 AS sk"))
    used = []
    for name in ("upsert", "upsert_by_range"):
        monkeypatch.setattr(tables, name, lambda *a, f=getattr(tables, name), n=name: (used.append(n), f(*a))[1])
    for table, buckets in (("whole", 0), ("dealt", 16)):
        merge_table(old, f"{database}.{table}", ["k"], "sk", key_buckets=buckets)
        merge_table(new, f"{database}.{table}", ["k"], "sk")
    monkeypatch.setattr(merge, "HOT_KEY_ROWS", 0)
    merge_table(old, f"{database}.hot", ["k"], "sk", key_buckets=16)
    merge_table(new, f"{database}.hot", ["k"], "sk")
    assert used == ["upsert", "upsert_by_range", "upsert"]
    want = sorted_rows(spark.table(f"{database}.whole"), "k", "v", "sk")
    assert sorted_rows(spark.table(f"{database}.dealt"), "k", "v", "sk") == sorted_rows(spark.table(f"{database}.hot"), "k", "v", "sk") == want


def test_hot_keys_are_seen(spark, monkeypatch):
    monkeypatch.setattr(merge, "HOT_KEY_ROWS", 50)
    even = stage(spark.range(5000).selectExpr("id AS k", "if(id % 2 = 0, NULL, 1) AS n"))
    assert not has_hot_key(even, ["k"]) and not has_hot_key(even, ["k", "n"]) and not has_hot_key(even.limit(0), ["k"])
    assert has_hot_key(even.unionAll(spark.sql("SELECT 77L, 1 FROM range(200)")), ["k", "n"])
    # Rows without a key are not matched.
    assert not has_hot_key(even.unionAll(spark.sql("SELECT 77L, NULL FROM range(200)")), ["k", "n"])


@pytest.mark.parametrize("large", [False, True])
def test_a_merge_moves_what_it_wrote_once_and_leaves_the_old_files(spark, database, large, request):
    if large:
        request.getfixturevalue("nothing_fits")
    table = f"{database}.t"
    merge_table(spark.range(4000).selectExpr("id AS k", "id AS v", "id AS sk"), table, ["k"], "sk", key_buckets=8)
    before = where_is(spark, table)
    merge_table(spark.sql("SELECT 5L AS k, -1L AS v, 9000L AS sk"), table, ["k"], "sk")
    after = where_is(spark, table)
    changed = [b for b in after if after[b] != before[b]]
    assert len(changed) == 1 and all(os.path.exists(p) for paths in before.values() for p in paths)
    merge_table(spark.range(3990, 4010).selectExpr("id AS k", "-id AS v", "id + 9000 AS sk"), table, ["k"], "sk")
    want = sorted([(k, -1 if k == 5 else -k if k >= 3990 else k, k if k < 4000 else k + 9000) for k in range(4010)], key=repr)
    assert sorted_rows(spark.table(table), "k", "v", "sk") == want
    assert drop_old_versions(spark, table) > 0 and drop_old_versions(spark, table) == 0
    spark.catalog.refreshTable(table)
    assert sorted_rows(spark.table(table), "k", "v", "sk") == want
    top = tables._detail(spark, table, "Location").removeprefix("file:").rsplit("/", 1)[0]
    left = set(glob.glob(f"{top}/version-*/*/*.parquet"))
    assert left == {p for paths in where_is(spark, table).values() for p in paths}
    merge_table(spark.sql("SELECT 6L AS k, -2L AS v, 1L AS sk"), table, ["k"], "sk")
    assert spark.table(table).where("k = 6 AND v = -2 AND sk = 6").count() == 1 and spark.table(table).count() == 4010


def test_buckets_are_written_again_where_they_cannot_be_moved(spark, database, monkeypatch):
    table, file_system, asked = f"{database}.t", tables._file_system, []

    def elsewhere(spark, path):
        place, system = file_system(spark, path)
        asked.append(path)
        uri = SimpleNamespace(toString=lambda: f"store of {path}")
        return place, SimpleNamespace(getUri=lambda: uri, getScheme=system.getScheme, exists=system.exists)

    merge_table(spark.range(100).selectExpr("id AS k", "id AS v", "id AS sk"), table, ["k"], "sk", key_buckets=4)
    monkeypatch.setattr(tables, "_file_system", elsewhere)
    merge_table(spark.range(90, 110).selectExpr("id AS k", "-id AS v", "id AS sk"), table, ["k"], "sk")
    assert sorted_rows(spark.table(table), "k", "v") == sorted([(k, k if k < 90 else -k) for k in range(110)], key=repr)


def test_an_unfinished_move_is_named_and_a_second_merge_repairs(spark, database, monkeypatch):
    table = f"{database}.t"
    merge_table(spark.range(100).selectExpr("id AS k", "id AS v", "id AS sk"), table, ["k"], "sk", key_buckets=4)
    batch = spark.range(100).selectExpr("id AS k", "-id AS v", "id AS sk")

    class Broken:
        """A session whose second change of a partition's place fails."""

        def __init__(self):
            self.changes = 0

        def __getattr__(self, name):
            return getattr(spark, name)

        def sql(self, text):
            self.changes += "SET LOCATION" in text
            if self.changes == 2:
                raise OSError("injected")
            return spark.sql(text)

    whole = tables._overwrite_partitions
    with monkeypatch.context() as patch:
        patch.setattr(tables, "_overwrite_partitions", lambda s, *more: whole(Broken(), *more))
        with pytest.raises(RuntimeError, match="version-") as raised:
            merge_table(batch, table, ["k"], "sk")
    assert spark.read.parquet(str(raised.value).rsplit(" ", 1)[1]).count() == 100
    spark.catalog.refreshTable(table)
    assert spark.table(table).count() == 100
    merge_table(batch, table, ["k"], "sk")
    assert sorted_rows(spark.table(table), "k", "v") == sorted([(k, -k) for k in range(100)], key=repr)


def test_small_merges_gather_small_files_in_time(spark, database, monkeypatch):
    monkeypatch.setattr(tables, "_SMALL_FILES", 2)
    table = f"{database}.t"
    merge_table(spark.range(1000).selectExpr("id AS k", "id AS v", "id AS sk"), table, ["k"], "sk", key_buckets=2)
    for turn in range(5):
        rows = stage(spark.range(2000 + 100 * turn, 2100 + 100 * turn, 1, 6).selectExpr("id AS k", "id AS v", "id AS sk"))
        merge_table(rows, table, ["k"], "sk")
        assert sum(len(paths) for paths in where_is(spark, table).values()) <= 8
    assert spark.table(table).count() == 1500 and spark.table(table).agg(F.sum("k")).first()[0] == sum([*range(1000), *range(2000, 2500)])
