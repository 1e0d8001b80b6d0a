"""Bronze -> silver: one entity is read, projected, transformed and written."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from stratiform.operators.dedupe import keep_newest
from stratiform.operators.numbering import max_key, number_rows
from stratiform.operators.shape import override_types, project
from stratiform.plans.at_once import run_at_once
from stratiform.sinks.tables import table_exists, write_entity
from stratiform.sources.readers import read_source
from stratiform.spec import EntitySpec
from stratiform.workspace import staging_scope

log = logging.getLogger(__name__)

Transform = Callable[[DataFrame, EntitySpec], DataFrame]


def default_transform(df: DataFrame, spec: EntitySpec) -> DataFrame:
    """Casts, then the newest row per key, then a surrogate key above those in use."""
    spark = df.sparkSession
    typed = override_types(df, spec.override_column_types, spec.strict_casts)
    newest = keep_newest(typed, spec.business_key, beside=[spec.source_file_column])
    used = max_key(spark.table(spec.destination), spec.surrogate_key) if table_exists(spark, spec.destination) else 0
    return number_rows(newest, spec.surrogate_key, after=used)


TRANSFORMS: dict[str, Transform] = {"default": default_transform}


def register_transform(name: str, transform: Transform) -> None:
    TRANSFORMS[name] = transform


def transform_entity(df: DataFrame, spec: EntitySpec) -> DataFrame:
    if spec.custom_transform not in TRANSFORMS:
        raise ValueError(f"unknown transformation: {spec.custom_transform}")
    return TRANSFORMS[spec.custom_transform](df, spec)


def run_entity(spark: SparkSession, spec: EntitySpec, root: str = "") -> None:
    """Process one entity; what is staged on the way is removed afterwards."""
    log.info("entity %s: start", spec.destination)
    try:
        with staging_scope(spark):
            bronze = project(read_source(spark, spec, root), spec.kept_columns())
            write_entity(transform_entity(bronze, spec), spec)
    except Exception:
        log.exception("entity %s: failed", spec.destination)
        raise
    log.info("entity %s: done", spec.destination)


def run_entities(
    spark: SparkSession, specs: Iterable[EntitySpec], root: str = "", only: str | None = None, at_once: int = 1
) -> list[str]:
    """Process all entities, or the one written to table `only`; the first failure stops the run.

    `at_once` entities are processed at the same time, those of one table one after the other in their order. A
    failure then cancels those that run beside it.
    """
    chosen = [s for s in specs if only is None or s.destination == only]
    if only is not None and not chosen:
        raise ValueError(f"no entity is written to {only}")
    if at_once > 1:
        steps, after, last = {}, {}, {}
        for number, spec in enumerate(chosen):
            name, table = f"{number} {spec.destination}", spec.destination.lower()
            steps[name] = lambda done, spec=spec: run_entity(spark, spec, root)
            after[name] = [last[table]] if table in last else []
            last[table] = name
        run_at_once(spark, steps, after, at_once)
    else:
        for spec in chosen:
            run_entity(spark, spec, root)
    return [s.destination for s in chosen]
