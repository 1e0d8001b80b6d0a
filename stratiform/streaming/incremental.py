"""Load only the files that arrived since the last run, for merged and for appended entities.

A full entity run reads the whole bronze tree each time. For a merged entity the same table results from
reading each load once, because a match only updates when the incoming row is not older. An appended entity
gets each new file's rows once.

A file stream over file names finds what is new; it never opens a file. Each batch of new files is read
by its format: footers, headers and archives of earlier loads are not opened again. What the columns of
earlier loads were is kept beside the checkpoint.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.operators.dedupe import orderable
from stratiform.operators.shape import project, with_source_file
from stratiform.plans.silver import transform_entity
from stratiform.sinks.tables import append_batch, batch_is_there, merge_table, table_exists
from stratiform.sources.drift import read_drifting_parquet
from stratiform.sources.readers import source_path
from stratiform.sources.zipped import read_zip_csv
from stratiform.spec import LOAD_TYPES, RECENCY_COLUMNS, EntitySpec
from stratiform.workspace import qualified, stage, staging_scope

#: New files of one batch, whose names are on the driver at once.
FILES_PER_BATCH = 10_000

_LISTED = "path string, modificationTime timestamp, length long, content binary"

# Reads the files named in a table (path) below a folder; the columns known so far, if any, come last.
NewFiles = Callable[[SparkSession, str, EntitySpec, DataFrame, T.StructType | None], DataFrame]


def _paths(files: DataFrame) -> list[str]:
    """At most `FILES_PER_BATCH` names."""
    return [r["path"] for r in files.orderBy("path").collect()]


def _parquet(spark: SparkSession, root: str, spec: EntitySpec, files: DataFrame, known: T.StructType | None) -> DataFrame:
    # Every new file has a say in the schema, so a column that a later load brings arrives.
    reader = spark.read.options(**{"mergeSchema": "true", **spec.options}).option("basePath", root)
    return with_source_file(reader.parquet(*_paths(files)), spec.source_file_column)


def _csv(spark: SparkSession, root: str, spec: EntitySpec, files: DataFrame, known: T.StructType | None) -> DataFrame:
    # Text whose header does not name the columns read so far raises instead of shifting them.
    headed = str(spec.options.get("header")).lower() == "true"
    options = {**spec.options, **({"enforceSchema": "false"} if headed else {})}
    paths = _paths(files)
    reader = lambda: spark.read.options(**options).option("basePath", root)
    own = [f for f in known or [] if f.name != spec.source_file_column]
    schema = T.StructType(own) if own else _with_load_types(reader().csv(paths)).schema
    return with_source_file(reader().schema(schema).csv(paths), spec.source_file_column)


def _zip_csv(spark: SparkSession, root: str, spec: EntitySpec, files: DataFrame, known: T.StructType | None) -> DataFrame:
    return read_zip_csv(spark, root, spec.options, files, spec.source_file_column)


def _drifting(spark: SparkSession, root: str, spec: EntitySpec, files: DataFrame, known: T.StructType | None) -> DataFrame:
    types, strict = spec.override_column_types, spec.strict_casts
    return read_drifting_parquet(spark, root, types, spec.options, strict, files, spec.source_file_column)


# Format names and the endings of their files.
NEW_FILES: dict[str, tuple[str, NewFiles]] = {
    "parquet": ("*.[pP][aA][rR][qQ][uU][eE][tT]", _parquet),
    "csv": ("*", _csv),
    "zip_csv": ("*.[zZ][iI][pP]", _zip_csv),
    "new_york_taxi": ("*.[pP][aA][rR][qQ][uU][eE][tT]", _drifting),
}


def _with_load_types(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast(t) for c, t in LOAD_TYPES.items() if c in df.columns})


class KnownColumns:
    """The columns that loads have had so far, as one small file per batch that brought new ones."""

    def __init__(self, checkpoint: str):
        self.folder = f"{checkpoint.rstrip('/')}-columns"

    def read(self, spark: SparkSession) -> T.StructType | None:
        try:
            kept = spark.read.text(f"{self.folder}/batch-*", wholetext=True).select("value", "_metadata.file_path")
            newest = kept.orderBy(F.col("file_path").desc()).first()
        except AnalysisException:
            return None
        return T.StructType.fromJson(json.loads(newest["value"])) if newest else None

    def add(self, df: DataFrame, known: T.StructType | None, batch: int) -> DataFrame:
        """`df` with the columns it lacks as NULL; new columns are written down."""
        spark = df.sparkSession
        fields = list(known or [])
        names = {f.name for f in fields}
        new = [T.StructField(f.name, f.dataType) for f in df.schema.fields if f.name not in names]
        if new:
            text = T.StructType([*fields, *new]).json()
            spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.folder}/batch-{batch:012}")
        lacking = {f.name: F.lit(None).cast(f.dataType) for f in fields if f.name not in df.columns}
        return df.withColumns(lacking) if lacking else df


def merge_new_loads(
    spark: SparkSession, spec: EntitySpec, checkpoint: str, root: str = "", files_per_batch: int = FILES_PER_BATCH
) -> None:
    """Process all files not yet recorded in `checkpoint`, then stop. For merged and appended entities.

    A merged batch repeated after a failure merges the same rows again and changes nothing, except that rows
    with NULL keys, which match nothing, are inserted again, as in every full run. An appended batch goes
    to a partition `load_batch` named after checkpoint and batch; if the table has that, nothing is added.
    """
    if spec.format not in NEW_FILES:
        raise ValueError(f"format {spec.format} cannot be loaded incrementally")
    if spec.load_type not in ("merge", "append"):
        raise ValueError("only merged and appended entities can be loaded incrementally")

    path = source_path(spec, root)
    pattern, read = NEW_FILES[spec.format]
    columns = KnownColumns(checkpoint)
    stream = hashlib.sha256(qualified(spark, checkpoint).encode()).hexdigest()[:16]

    def load(batch: DataFrame, number: int) -> None:
        session, name = batch.sparkSession, f"{stream}-{number:012}"
        if spec.load_type == "append" and batch_is_there(session, spec.destination, name):
            return
        with staging_scope(session):
            files = stage(batch.select("path"), "new_files")
            if files.isEmpty():
                return
            known = columns.read(session)
            rows = columns.add(_with_load_types(read(session, path, spec, files, known)), known, number)
            rows = transform_entity(project(rows, spec.kept_columns()), spec)
            if spec.load_type == "append":
                append_batch(rows, spec.destination, name)
            else:
                _merge(rows, spec)

    listing = spark.readStream.format("binaryFile").schema(_LISTED).option("recursiveFileLookup", "true")
    listing = listing.option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_per_batch)
    listing.load(path).select("path").writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(
        availableNow=True
    ).start().awaitTermination()
    if table_exists(spark, spec.destination):
        # Batches run in a session of their own; this one may still know the table as it was.
        spark.catalog.refreshTable(spec.destination)


def _merge(rows: DataFrame, spec: EntitySpec) -> None:
    content = [
        f.name
        for f in rows.schema.fields
        if f.name not in (*RECENCY_COLUMNS, *spec.business_key, spec.surrogate_key) and orderable(f.dataType)
    ]
    default = spec.custom_transform == "default"
    merge_table(
        rows,
        spec.destination,
        spec.business_key,
        spec.surrogate_key,
        newest_by=[*RECENCY_COLUMNS, *content],
        source_is_unique=default,
        source_is_written=default,
        key_buckets=spec.key_buckets,
    )
