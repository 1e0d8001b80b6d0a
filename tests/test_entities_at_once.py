"""Entities of a whole run at the same time: finding F3 of round 3."""

import threading

import pytest
from pyspark.sql import functions as F

from stratiform.plans.silver import default_transform, register_transform, run_entities
from test_runs import DAY_1, land, leave_registries_alone, spec  # noqa: F401


def test_entities_of_different_tables_run_at_once_and_those_of_one_in_order(spark, tmp_path, database, rows, leave_registries_alone):  # noqa: F811
    land(spark, tmp_path, DAY_1, [("a", "1"), ("b", "2")])
    met, order = threading.Barrier(2, timeout=120), []

    def meet(df, entity):
        met.wait()
        order.append("first")
        return default_transform(df, entity)

    def later(df, entity):
        order.append("second")
        return default_transform(df.withColumn("v", F.lit("9")), entity)

    register_transform("meet", meet)
    register_transform("later", later)
    one, two = (spec(database, custom_transform="meet", destination=f"{database}.{n}") for n in ("one", "two"))
    again = spec(database, custom_transform="later", destination=f"{database}.ONE")
    assert run_entities(spark, [one, again, two], str(tmp_path), at_once=3) == [one.destination, again.destination, two.destination]
    assert order.index("second") > 0 and rows(spark.table(one.destination), "k", "v") == [("a", "9"), ("b", "9")]
    assert rows(spark.table(two.destination), "k", "v") == [("a", "1"), ("b", "2")]


def test_a_failure_stops_what_has_not_begun(spark, tmp_path, database):
    land(spark, tmp_path, DAY_1, [("a", "1")])
    absent = spec(database, source="absent", destination=f"{database}.t")
    after = spec(database, destination=f"{database}.t")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        run_entities(spark, [absent, after], str(tmp_path), at_once=3)
    assert not spark.catalog.tableExists(f"{database}.t")
