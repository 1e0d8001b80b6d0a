"""Readers by source format."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stratiform.operators.shape import with_source_file
from stratiform.sources.drift import read_drifting_parquet
from stratiform.sources.zipped import read_zip_csv
from stratiform.spec import EntitySpec

Reader = Callable[[SparkSession, str, EntitySpec], DataFrame]


def _parquet(spark: SparkSession, path: str, spec: EntitySpec) -> DataFrame:
    return with_source_file(spark.read.options(**spec.options).parquet(path), spec.source_file_column)


def _csv(spark: SparkSession, path: str, spec: EntitySpec) -> DataFrame:
    return with_source_file(spark.read.options(**spec.options).csv(path), spec.source_file_column)


def _zip_csv(spark: SparkSession, path: str, spec: EntitySpec) -> DataFrame:
    return read_zip_csv(spark, path, spec.options, source_file=spec.source_file_column)


def _drifting_parquet(spark: SparkSession, path: str, spec: EntitySpec) -> DataFrame:
    return read_drifting_parquet(
        spark, path, spec.override_column_types, spec.options, spec.strict_casts, source_file=spec.source_file_column
    )


# The format names entity specifications use.
READERS: dict[str, Reader] = {
    "parquet": _parquet,
    "csv": _csv,
    "zip_csv": _zip_csv,
    "new_york_taxi": _drifting_parquet,
}


def register_reader(name: str, reader: Reader) -> None:
    READERS[name] = reader


def source_path(spec: EntitySpec, root: str = "") -> str:
    """Where the entity's bronze lies; `root` is the lakehouse folder its source is relative to."""
    return f"{root.rstrip('/')}/{spec.source}" if root else spec.source


def read_source(spark: SparkSession, spec: EntitySpec, root: str = "") -> DataFrame:
    """Read the bronze rows of an entity."""
    if spec.format not in READERS:
        raise ValueError(f"unsupported source format: {spec.format}")
    return READERS[spec.format](spark, source_path(spec, root), spec)
