import random

import pytest
from pyspark.sql import functions as F

from stratiform.operators.dedupe import keep_newest
from stratiform.operators.numbering import max_key, number_rows
from stratiform.operators.shape import add_audit_columns, override_present_types, override_types, project
from stratiform.spec import LOAD_COLUMNS

LOADS = "segment string, year int, month int, day int, load bigint"


def test_audit_columns_stamp_a_whole_frame_alike(spark):
    trips = spark.createDataFrame([("a", None, 1.5), (None, "x", None)] * 4, "k string, note string, v double").repartition(4)
    stamped = add_audit_columns(trips, "Bob's \"feed\"")
    assert stamped.schema.names[:3] == trips.schema.names
    assert sorted(stamped.drop("audit_timestamp", "audit_source").collect(), key=repr) == sorted(trips.collect(), key=repr)
    stamps = {(r["audit_timestamp"], r["audit_source"]) for r in stamped.collect()}
    assert len(stamps) == 1 and stamps.pop()[1] == "Bob's \"feed\""


def test_newest_load_wins_even_with_a_smaller_load_number(spark, rows):
    df = spark.createDataFrame(
        [
            (1, "a", "s", 2024, 1, 1, 100),
            (1, "b", "s", 2024, 1, 1, 200),
            (1, "c", "s", 2024, 1, 2, 50),
            (2, "d", "s", 2023, 12, 31, 900),
        ],
        f"k int, v string, {LOADS}",
    )
    assert rows(keep_newest(df, ["k"]), "k", "v") == [(1, "c"), (2, "d")]


def test_null_keys_form_one_group(spark, rows):
    df = spark.createDataFrame(
        [(None, "a", "s", 2024, 1, 1, 1), (None, "b", "s", 2024, 1, 1, 2), (3, "c", "s", 2024, 1, 1, 1)],
        f"k int, v string, {LOADS}",
    )
    assert rows(keep_newest(df, ["k"]), "k", "v") == [(3, "c"), (None, "b")]


def test_without_key_the_row_is_the_key_and_segment_carries_no_recency(spark, rows):
    df = spark.createDataFrame(
        [
            (1, "a", "initial", 2024, 1, 1, 1),
            (1, "a", "incremental", 2024, 1, 1, 2),
            (1, "z", "zzz", 2024, 1, 1, 0),
        ],
        f"k int, v string, {LOADS}",
    )
    assert rows(keep_newest(df), "k", "v", "segment", "load") == [(1, "a", "incremental", 2), (1, "z", "zzz", 0)]


def test_equal_loads_are_settled_by_the_remaining_columns(spark, rows):
    data = [(1, v, "s", 2024, 1, 1, 1) for v in ("a", "c", "b", None)]
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, f"k int, v string, {LOADS}").repartition(3)
        assert rows(keep_newest(df, ["k"]), "v") == [("c",)]


def test_dedupe_matches_brute_force(spark, rows):
    rng = random.Random(7)
    data = [
        (
            rng.choice([None, 1, 2, 3]),
            rng.choice([None, "x", "y"]),
            rng.randint(0, 3),
            "s",
            rng.randint(2023, 2024),
            rng.randint(1, 2),
            rng.randint(1, 2),
            rng.randint(1, 3),
        )
        for _ in range(400)
    ]
    best = {}
    for row in data:
        order = (*row[4:8], row[2])
        if row[:2] not in best or order > best[row[:2]][0]:
            best[row[:2]] = (order, row)
    df = spark.createDataFrame(data, f"a int, b string, v int, {LOADS}").repartition(5)
    assert rows(keep_newest(df, ["a", "b"])) == sorted((r for _, r in best.values()), key=repr)


def test_each_task_keeps_one_row_per_key_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr(
        "id % 3 AS k", "id AS v", "'s' AS segment", "2024 AS year", "1 AS month", "1 AS day", "id AS load"
    )
    plan = keep_newest(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_numbers_are_dense_and_start_after_the_largest_key(spark, partitions):
    df = spark.range(0, 1000, 1, partitions).withColumn("k", F.col("id") * 7)
    keyed = number_rows(df, "sk", after=100)
    assert dict(keyed.dtypes)["sk"] == "bigint"
    assert sorted(r.sk for r in keyed.collect()) == list(range(101, 1101))


def test_numbers_do_not_change_when_read_again(spark):
    keyed = number_rows(spark.range(0, 500, 1, 7).orderBy(F.rand()), "sk")
    assert {(r.id, r.sk) for r in keyed.collect()} == {(r.id, r.sk) for r in keyed.collect()}


def test_numbers_follow_the_requested_order(spark):
    df = spark.range(0, 2000, 1, 8).select(F.when(F.col("id") % 10 > 0, F.col("id") * 37 % 2003).alias("k"), "id")
    got = number_rows(df, "n", order_by=["k", "id"]).orderBy("n").collect()
    assert [r.n for r in got] == list(range(1, 2001))
    assert [(r.k, r.id) for r in got] == sorted(
        ((r.k, r.id) for r in got), key=lambda p: (p[0] is not None, p[0] or 0, p[1])
    )


def test_numbers_pass_the_int_range(spark):
    assert number_rows(spark.range(1), "sk", after=2147483647).first().sk == 2147483648


def test_numbering_nothing_gives_nothing(spark):
    assert number_rows(spark.range(0), "sk", after=5).count() == 0


def test_largest_key_of_an_empty_table_is_zero(spark):
    assert max_key(spark.range(0), "id") == 0
    assert max_key(spark.range(5), "id") == 4


def test_strict_cast_raises_and_lenient_cast_gives_null(spark):
    df = spark.createDataFrame([("1.5",), ("abc",)], ["v"])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        override_types(df, {"v": "double"}).collect()
    assert [r.v for r in override_types(df, {"v": "double"}, strict=False).collect()] == [1.5, None]


def test_lenient_casts_of_text_equal_plain_ones(spark):
    texts = ["1", " 1.5 ", "-2e3", "1d", "Infinity", "-inf", "NaN", "nan", "+INF", "abc", "", " ", "-", "one 1", None]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    for type_name in ("double", "float", "decimal(10,2)", "int", "date", "boolean"):
        got = override_types(df, {"v": type_name}, strict=False)
        want = df.select(F.col("v").try_cast(type_name).alias("v"))
        assert repr(got.collect()) == repr(want.collect()), type_name


def test_lenient_casts_of_integers_equal_plain_ones(spark):
    edges = [e + d for bits in (7, 15, 31) for e in (1 << bits, -(1 << bits)) for d in (-1, 0, 1)] + [0, None, 2**63 - 1]
    df = spark.createDataFrame([(e,) for e in edges], "v bigint")
    for type_name in ("tinyint", "smallint", "int", "bigint", "double", "string"):
        got = override_types(df, {"v": type_name}, strict=False)
        assert got.collect() == df.select(F.col("v").try_cast(type_name).alias("v")).collect(), type_name


def test_absent_column_is_an_error_unless_only_present_ones_are_asked_for(spark):
    df = spark.range(1)
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        override_types(df, {"nope": "int"}).collect()
    assert override_present_types(df, {"nope": "int", "id": "string"}).dtypes == [("id", "string")]


def test_projection_without_columns_keeps_all(spark):
    df = spark.range(1).withColumn("x", F.lit(1))
    assert project(df, []).columns == ["id", "x"]
    assert project(df, ["x"]).columns == ["x"]


def test_load_columns():
    assert LOAD_COLUMNS == ("segment", "year", "month", "day", "load")
