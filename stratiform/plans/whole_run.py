"""The whole run: land, bronze -> silver, silver -> gold, each after the one before succeeded."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from stratiform.plans.at_once import AT_ONCE
from stratiform.plans.gold import build_gold
from stratiform.plans.silver import run_entities
from stratiform.sinks.tables import drop_old_versions
from stratiform.spec import EntitySpec

# The silver tables gold is built from.
SILVER_TABLES = ("new_york_taxi", "citi_bike", "weather")


def run_all(
    spark: SparkSession,
    specs: Iterable[EntitySpec],
    root: str = "",
    landings: Iterable[Callable[[], object]] = (),
    silver_schema: str = "dbo",
    gold_schema: str = "gold",
    drop_old: bool = False,
    at_once: int = AT_ONCE,
) -> dict[str, DataFrame]:
    """The entities, then the tables of the star, are processed `at_once` at a time.

    `drop_old` removes, after success, the versions of tables that merges and rebuilds no longer use."""
    specs = list(specs)
    for land in landings:
        land()
    run_entities(spark, specs, root, at_once=at_once)
    taxi, bike, weather = (spark.table(f"{silver_schema}.{name}") for name in SILVER_TABLES)
    star = build_gold(spark, taxi, bike, weather, gold_schema, at_once)
    if drop_old:
        merged = [s.destination for s in specs if s.load_type == "merge"]
        for table in (*merged, *(f"{gold_schema}.{name}" for name in star)):
            drop_old_versions(spark, table)
    return star
