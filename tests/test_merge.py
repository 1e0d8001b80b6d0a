import random

import pytest

from stratiform.operators.merge import upsert
from stratiform.sinks.tables import append_table, drop_old_versions, merge_table, replace_table

TARGET = [(1, "a", 10), (2, "b", 20), (3, None, 30)]
SOURCE = [(4, "a", 11), (5, None, 31), (6, "c", 40)]
MERGED = [(1, "a", 11), (2, "b", 20), (3, None, 30), (5, None, 31), (6, "c", 40)]
SCHEMA = "sk bigint, k string, v int"


# A limit of 0 rules out every broadcast, so both ways to join are covered.
@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_matched_rows_keep_their_key_and_null_keys_never_match(spark, rows, limit):
    target, source = spark.createDataFrame(TARGET, SCHEMA), spark.createDataFrame(SOURCE, SCHEMA)
    assert rows(upsert(target, source, ["k"], "sk", limit_bytes=limit)) == sorted(MERGED, key=repr)


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_merge_matches_brute_force(spark, rows, limit):
    rng = random.Random(3)
    keys = [(a, b) for a in (None, 1, 2, 3, 4) for b in (None, "x", "y", "z")]
    target = [(i, *rng.choice(keys), rng.randint(0, 99)) for i in range(60)]
    source = [(1000 + i, *k, rng.choice([None, 1, 2])) for i, k in enumerate(rng.sample(keys, 12))]
    by_key = {r[1:3]: r for r in source if None not in r[1:3]}
    present = {r[1:3] for r in target}
    want = [(r[0], r[1], r[2], by_key[r[1:3]][3] if r[1:3] in by_key else r[3]) for r in target]
    want += [r for r in source if None in r[1:3] or r[1:3] not in present]
    schema = "sk bigint, a int, b string, v int"
    got = upsert(
        spark.createDataFrame(target, schema), spark.createDataFrame(source, schema), ["a", "b"], "sk", limit_bytes=limit
    )
    assert rows(got) == sorted(want, key=repr)


def test_null_values_of_the_source_overwrite(spark, rows):
    target = spark.createDataFrame([(1, "a", 10)], SCHEMA)
    source = spark.createDataFrame([(2, "a", None)], SCHEMA)
    assert rows(upsert(target, source, ["k"], "sk")) == [(1, "a", None)]


def test_target_only_columns_stay_or_become_null(spark, rows):
    target = spark.createDataFrame([(1, "a", 10, "x")], SCHEMA + ", note string")
    source = spark.createDataFrame([(2, "a", 11), (3, "b", 12)], SCHEMA)
    assert rows(upsert(target, source, ["k"], "sk")) == [(1, "a", 11, "x"), (3, "b", 12, None)]


def test_the_target_keeps_its_column_types(spark, database, rows):
    name = f"{database}.t"
    append_table(spark.createDataFrame([(1, "a", 10), (2, "7", 20)], SCHEMA), name)
    merge_table(spark.createDataFrame([(3, 7, "21")], "sk int, k int, v string"), name, ["k"], "sk")
    assert spark.table(name).dtypes == [("sk", "bigint"), ("k", "string"), ("v", "int")]
    assert rows(spark.table(name)) == [(1, "a", 10), (2, "7", 21)]


def test_older_source_rows_do_not_overwrite_when_recency_counts(spark, rows):
    schema = "sk bigint, k string, day int, v int"
    target = spark.createDataFrame([(1, "a", 5, 10), (2, "b", 5, 20), (3, "c", 5, 30)], schema)
    source = spark.createDataFrame([(4, "a", 4, 11), (5, "b", 6, 21), (6, "d", 1, 41)], schema)
    got = upsert(target, source, ["k"], "sk", newest_by=["day"])
    assert rows(got) == [(1, "a", 5, 10), (2, "b", 6, 21), (3, "c", 5, 30), (6, "d", 1, 41)]


def test_two_source_rows_for_one_target_row_are_refused(spark, rows):
    target = spark.createDataFrame(TARGET, SCHEMA)
    with pytest.raises(ValueError, match="match one target row"):
        upsert(target, spark.createDataFrame([(7, "a", 1), (8, "a", 2)], SCHEMA), ["k"], "sk")
    # Two that match nothing are both inserted.
    got = upsert(target, spark.createDataFrame([(7, "n", 1), (8, "n", 2)], SCHEMA), ["k"], "sk")
    assert got.count() == 5


def test_empty_key_and_unknown_column_are_refused(spark, database):
    target = spark.createDataFrame(TARGET, SCHEMA)
    with pytest.raises(ValueError, match="key column"):
        merge_table(target, f"{database}.t", [], "sk")
    with pytest.raises(ValueError, match="no column extra"):
        upsert(target, spark.createDataFrame([(1, "a", 1, 1)], SCHEMA + ", extra int"), ["k"], "sk")


def test_merge_into_a_table_that_is_absent_appends(spark, database, rows):
    merge_table(spark.createDataFrame(SOURCE, SCHEMA), f"{database}.t", ["k"], "sk")
    assert rows(spark.table(f"{database}.t")) == sorted(SOURCE, key=repr)


def test_merge_into_a_table_and_drop_its_old_versions(spark, database, rows):
    name = f"{database}.t"
    append_table(spark.createDataFrame(TARGET, SCHEMA), name)
    merge_table(spark.createDataFrame(SOURCE, SCHEMA), name, ["k"], "sk")
    assert rows(spark.table(name)) == sorted(MERGED, key=repr)
    assert drop_old_versions(spark, name) == 1
    assert rows(spark.table(name)) == sorted(MERGED, key=repr)
    append_table(spark.createDataFrame([(9, "z", 0)], SCHEMA), name)
    assert spark.table(name).count() == 6


def test_append_goes_by_column_name(spark, database, rows):
    name = f"{database}.t"
    append_table(spark.createDataFrame([(1, "a", 10)], SCHEMA), name)
    append_table(spark.createDataFrame([("b", 20, 2)], "k string, v int, sk bigint"), name)
    assert rows(spark.table(name)) == [(1, "a", 10), (2, "b", 20)]


def test_replace_may_read_the_table_and_may_change_its_columns(spark, database, rows):
    name = f"{database}.t"
    replace_table(spark.createDataFrame(TARGET, SCHEMA), name)
    replace_table(spark.table(name).withColumn("v", spark.table(name).v + 1), name)
    assert rows(spark.table(name), "v") == [(11,), (21,), (31,)]
    replace_table(spark.table(name).select("k"), name)
    assert spark.table(name).columns == ["k"]


def test_a_failed_replace_leaves_the_table_as_it_was(spark, database, rows):
    name = f"{database}.t"
    replace_table(spark.createDataFrame(TARGET, SCHEMA), name)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        replace_table(spark.table(name).selectExpr("sk", "k", "cast(coalesce(k, 'x') AS int) AS v"), name)
    assert rows(spark.table(name)) == sorted(TARGET, key=repr)
