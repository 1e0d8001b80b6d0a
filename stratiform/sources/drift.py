"""Parquet file sets whose column types and columns drift from file to file."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce
from itertools import groupby

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.operators.numbering import number_rows
from stratiform.operators.shape import override_present_types, with_source_file
from stratiform.sources.files import list_files, open_filesystem
from stratiform.spec import LOAD_TYPES
from stratiform.workspace import new_path, stage

# Fixed value: the footer entry in which Spark keeps its own schema.
_SPARK_SCHEMA_ENTRY = b"org.apache.spark.sql.parquet.row.metadata"

_FOOTERS_PER_TASK = 64
#: Files of mixed folders that one scan names on the driver.
FILES_PER_SCAN = 10_000
_PARQUET_FILES = "*.[pP][aA][rR][qQ][uU][eE][tT]"


def _footer_schemas(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths = batch.column("path").to_pylist()
        layouts = []
        for uri in paths:
            filesystem, path = open_filesystem(uri)
            schema = pq.read_schema(path, filesystem=filesystem)
            stored = (schema.metadata or {}).get(_SPARK_SCHEMA_ENTRY, b"").decode()
            layouts.append(f"{schema.remove_metadata().to_string(show_field_metadata=False)}\n{stored}")
        yield pa.RecordBatch.from_pydict({"path": paths, "layout": layouts})


def placed_by_layout(spark: SparkSession, files: DataFrame) -> DataFrame:
    """path, layout (a hash of the physical schema) and folder of `files` (path), written. Tasks read the footers."""
    tasks = max(1, -(-files.count() // _FOOTERS_PER_TASK))
    described = files.select("path").repartition(tasks).mapInArrow(_footer_schemas, "path string, layout string")
    # A layout is hashed so that long schemas are not repeated for every file.
    layout, folder = F.sha2("layout", 256).alias("layout"), F.regexp_replace("path", "/[^/]*$", "").alias("folder")
    return stage(described.select("path", layout, folder), "layouts")


def whole_folders(placed: DataFrame) -> tuple[dict[str, list[str]], DataFrame]:
    """Folders to be scanned as a whole, by layout, and the files of the others.

    A folder is whole if its files share one layout and no folder with files lies below it.
    """
    folders = placed.groupBy("folder").agg(F.min("layout").alias("first"), F.max("layout").alias("last")).collect()
    above = {"/".join(r["folder"].split("/")[:n]) for r in folders for n in range(1, r["folder"].count("/") + 1)}
    whole = {r["folder"]: r["first"] for r in folders if r["first"] == r["last"] and r["folder"] not in above}
    groups: dict[str, list[str]] = {}
    for folder, layout in sorted(whole.items()):
        groups.setdefault(layout, []).append(folder)
    mixed = [(r["folder"],) for r in folders if r["folder"] not in whole]
    chosen = F.broadcast(placed.sparkSession.createDataFrame(mixed, "folder string"))
    return groups, placed.join(chosen, "folder", "left_semi") if mixed else placed.limit(0)


def in_turns(files: DataFrame, scan: Callable[[list[str]], DataFrame], files_per_scan: int) -> DataFrame:
    """The rows of `files` (path, layout), `files_per_scan` of them at a time, written as one table.

    Only the paths of the files whose turn it is are on the driver.
    """
    numbered = stage(number_rows(files.select("path", "layout"), "no", order_by=["layout", "path"]), "turns")
    examples = [r["path"] for r in numbered.groupBy("layout").agg(F.min("path").alias("path")).orderBy("layout").collect()]
    empty = union_by_name([scan([path]) for path in examples]).limit(0)
    turns = -(-numbered.count() // files_per_scan)
    written = new_path(files.sparkSession, "mixed_folders")
    for turn in range(turns):
        own = numbered.where(F.floor((F.col("no") - 1) / files_per_scan) == turn).orderBy("no").collect()
        layouts = [[r["path"] for r in rows] for _, rows in groupby(own, key=lambda r: r["layout"])]
        rows = union_by_name([empty, *(scan(paths) for paths in layouts)])
        rows.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in empty.schema.fields]).write.mode("append").parquet(written)
    return files.sparkSession.read.schema(empty.schema).parquet(written)


def union_by_name(scans: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), scans)


def read_drifting_parquet(
    spark: SparkSession,
    root: str,
    types: Mapping[str, str],
    options: Mapping[str, str] | None = None,
    strict: bool = True,
    files: DataFrame | None = None,
    source_file: str = "",
    files_per_scan: int = FILES_PER_SCAN,
) -> DataFrame:
    """Read every file with its own schema, cast the listed columns where present, union by name.

    One scan per distinct schema instead of one per file, so the plan grows with the number of layouts. Folders
    whose files share a schema are named as a whole. Files of mixed folders are named one by one; where they
    are more than `files_per_scan`, so many at a time are read and their rows written to the shared folder.
    `files` (path) are read instead of all below `root`; `source_file` names a column for the file of each row.
    """

    def scan(paths: Sequence[str]) -> DataFrame:
        reader = spark.read.options(**{"pathGlobFilter": _PARQUET_FILES, **(options or {})}).option("basePath", root)
        return override_present_types(with_source_file(reader.parquet(*paths), source_file), types, strict)

    def scan_some(paths: Sequence[str]) -> DataFrame:
        # The folders of some files alone may suggest a narrower type.
        rows = scan(paths)
        return rows.withColumns({c: F.col(c).cast(t) for c, t in LOAD_TYPES.items() if c in rows.columns and c not in types})

    try:
        placed = placed_by_layout(spark, list_files(spark, root, ".parquet") if files is None else files)
    except AnalysisException as error:
        raise FileNotFoundError(f"no Parquet files in {root}") from error
    groups, rest = whole_folders(placed) if files is None else ({}, placed)
    scans = [scan(paths) for paths in groups.values()]
    count = rest.count()
    if count > files_per_scan:
        scans.append(in_turns(rest, scan_some, files_per_scan))
    elif count:
        named = rest.select("layout", "path").orderBy("layout", "path").collect()
        scans += [scan([r["path"] for r in rows]) for _, rows in groupby(named, key=lambda r: r["layout"])]
    if not scans:
        raise FileNotFoundError(f"no Parquet files in {root}")
    return union_by_name(scans)
