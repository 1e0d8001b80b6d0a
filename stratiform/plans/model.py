"""Semantic model over gold: relationships, additive measures and star queries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratiform.operators.lookup import broadcast_if_small
from stratiform.workspace import stage


@dataclass(frozen=True)
class Relationship:
    """Many-to-one path from a fact column to a dimension key. Only active paths apply by default."""

    fact: str
    column: str
    dimension: str
    key: str
    active: bool = True


# The model's paths. The second role of a dimension is inactive.
RELATIONSHIPS = (
    Relationship("fact_taxi_trip", "pickup_date_sk", "dim_date", "date_sk"),
    Relationship("fact_taxi_trip", "pickup_time_sk", "dim_time", "time_sk"),
    Relationship("fact_taxi_trip", "dropoff_date_sk", "dim_date", "date_sk", active=False),
    Relationship("fact_taxi_trip", "dropoff_time_sk", "dim_time", "time_sk", active=False),
    Relationship("fact_weather_observation", "date_sk", "dim_date", "date_sk"),
    Relationship("fact_weather_observation", "time_sk", "dim_time", "time_sk"),
    Relationship("fact_weather_observation", "station_sk", "dim_weather_station", "station_sk"),
    Relationship("fact_bike_trip", "start_date_sk", "dim_date", "date_sk"),
    Relationship("fact_bike_trip", "start_time_sk", "dim_time", "time_sk"),
    Relationship("fact_bike_trip", "start_station_sk", "dim_bike_station", "station_sk"),
    Relationship("fact_bike_trip", "end_date_sk", "dim_date", "date_sk", active=False),
    Relationship("fact_bike_trip", "end_time_sk", "dim_time", "time_sk", active=False),
    Relationship("fact_bike_trip", "end_station_sk", "dim_bike_station", "station_sk", active=False),
)

# Columns that may be summed. All others only group.
MEASURES = {
    "fact_taxi_trip": (
        "passenger_count",
        "trip_distance",
        "fare_amount",
        "tip_amount",
        "tolls_amount",
        "total_amount",
        "trip_duration_seconds",
    ),
    "fact_weather_observation": (
        "temperature",
        "dew_point_temperature",
        "station_level_pressure",
        "altimeter",
    ),
    "fact_bike_trip": ("duration_seconds",),
}


def relationship_for(fact: str, dimension: str, use: Sequence[str] = ()) -> Relationship:
    """The path from fact to dimension: the one named in `use`, else the active one."""
    paths = [r for r in RELATIONSHIPS if r.fact == fact and r.dimension == dimension]
    chosen = [r for r in paths if r.column in use] or [r for r in paths if r.active]
    if len(chosen) != 1:
        raise ValueError(f"{len(chosen)} usable relationships from {fact} to {dimension}")
    return chosen[0]


def condition(column: Column, wanted: object) -> Column:
    """Whether a column has the wanted value, one of a list, or one within a tuple (from, to)."""
    if isinstance(wanted, tuple):
        low, high = wanted
        ends = [column >= F.lit(low)] * (low is not None) + [column <= F.lit(high)] * (high is not None)
        return reduce(and_, ends, column.isNotNull())
    if isinstance(wanted, (list, set, frozenset)):
        chosen = column.isin([v for v in wanted if v is not None])
        return chosen | column.isNull() if None in wanted else chosen
    return column.isNull() if wanted is None else column == F.lit(wanted)


def selected_facts(tables: Mapping[str, DataFrame], fact: str, where: Mapping[str, object], use: Sequence[str] = ()) -> DataFrame:
    """The facts that meet `where` ("dimension.column" or a column of the fact -> wanted values).

    Conditions on one dimension are put to it first. Its chosen keys then select the facts by a semi join, for
    which they are broadcast if measured to fit: where the fact is partitioned by the key, Spark prunes its
    partitions by them at run time. Their smallest and largest are put to the fact's scan as well, which skips
    row groups outside. The chosen keys are written, so the dimension is evaluated once for all of this.
    """
    facts = tables[fact]
    by_dimension: dict[str, dict[str, object]] = {}
    for attribute, wanted in where.items():
        table, column = attribute.split(".", 1) if "." in attribute else (fact, attribute)
        by_dimension.setdefault(table, {})[column] = wanted
    for column, wanted in by_dimension.pop(fact, {}).items():
        facts = facts.where(condition(F.col(column), wanted))
    for dimension, wanted in by_dimension.items():
        path = relationship_for(fact, dimension, use)
        chosen = tables[dimension].where(reduce(and_, (condition(F.col(c), w) for c, w in wanted.items())))
        keys = stage(chosen.select(F.col(path.key).alias("_key")).where("_key IS NOT NULL").distinct(), "chosen_keys")
        low, high = keys.agg(F.min("_key"), F.max("_key")).first()
        if low is None:
            return facts.limit(0)
        facts = facts.where(F.col(path.column).between(low, high))
        facts = facts.join(broadcast_if_small(keys), F.col(path.column) == F.col("_key"), "left_semi")
    return facts


def star_query(
    tables: Mapping[str, DataFrame],
    fact: str,
    measures: Sequence[str] | None = None,
    by: Sequence[str] = (),
    use: Sequence[str] = (),
    where: Mapping[str, object] | None = None,
) -> DataFrame:
    """Sums of measures by attributes ("dimension.column" or a column of the fact).

    `use` names fact columns of inactive relationships to follow instead of the active ones. Facts
    without a dimension row form the NULL group; groups whose sums are all NULL are left out.

    `where` keeps the facts whose attributes have the given values: a single value (None for NULL), a list of
    values, or a tuple (from, to) whose ends both count and may be None. A dimension's attributes select its
    keys, and only facts with one of those are read on; see `selected_facts`.

    The fact is summed by the keys it holds before anything is joined, so the fact itself is never
    shuffled row by row, a hot key collapses inside each task, and the joins see one row per key.
    """
    measures = list(MEASURES[fact] if measures is None else measures)
    refused = [m for m in measures if m not in MEASURES[fact]]
    if refused:
        raise ValueError(f"not additive in {fact}: {', '.join(refused)}")

    attributes = [a.split(".", 1) if "." in a else [fact, a] for a in by]
    dimensions = list(dict.fromkeys(d for d, _ in attributes if d != fact))
    paths = {d: relationship_for(fact, d, use) for d in dimensions}
    own = [column for table, column in attributes if table == fact]

    held = list(dict.fromkeys([p.column for p in paths.values()] + own))
    facts = selected_facts(tables, fact, where, use) if where else tables[fact]
    result = facts.groupBy(*held).agg(*[F.sum(m).alias(m) for m in measures])
    if dimensions:
        for dimension, path in paths.items():
            wanted = list(dict.fromkeys(c for d, c in attributes if d == dimension))
            side = tables[dimension].select(
                F.col(path.key).alias(f"_{dimension}_key"),
                *[F.col(c).alias(f"_{dimension}_{c}") for c in wanted],
            )
            result = result.join(side, F.col(path.column) == F.col(f"_{dimension}_key"), "left")
        groups = [F.col(c if t == fact else f"_{t}_{c}").alias(c) for t, c in attributes]
        result = result.groupBy(*groups).agg(*[F.sum(m).alias(m) for m in measures])
    return result.dropna(how="all", subset=measures) if by else result


def daily_sums(tables: Mapping[str, DataFrame], fact: str = "fact_weather_observation") -> DataFrame:
    """The report's line charts: every measure by date, oldest first."""
    return star_query(tables, fact, by=["dim_date.date"]).orderBy("date")


def totals(tables: Mapping[str, DataFrame], fact: str = "fact_weather_observation") -> DataFrame:
    """The report's cards: the grand total of every measure in one pass."""
    return star_query(tables, fact)
