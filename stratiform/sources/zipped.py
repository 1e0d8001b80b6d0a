"""Zip archives of delimited text below run-partitioned folders."""

from __future__ import annotations

import hashlib
import math
import shutil
import zipfile
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratiform.operators.lookup import broadcast_if_small
from stratiform.sources.files import list_files, open_filesystem, write_file
from stratiform.workspace import fresh_name, new_path, qualified, stage

_COPY_BYTES = 8 * 1024 * 1024
_TASK_BYTES = 256 * 1024 * 1024
_MOST_TASKS = 10_000
_ARCHIVES_PER_TASK = 16
_MARK_LENGTH = 32


def _hidden(member: str) -> bool:
    """Names Spark's own file listing passes over."""
    return any(part.startswith((".", "_")) for part in member.split("/"))


def _list_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for uri in batch.column("path").to_pylist():
            filesystem, path = open_filesystem(uri)
            with filesystem.open_input_file(path) as raw, zipfile.ZipFile(raw) as archive:
                rows += [
                    {"path": uri, "member": entry.filename, "size": entry.file_size}
                    for entry in archive.infolist()
                    if not entry.is_dir() and not _hidden(entry.filename)
                ]
        schema = pa.schema({"path": pa.string(), "member": pa.string(), "size": pa.int64()})
        yield pa.RecordBatch.from_pylist(rows, schema)


def staged_place(root: str, uri: str, member: str) -> tuple[str, str]:
    """Folder and file name, below the staging folder, of a member of the archive at `uri`.

    The folder has the Hive levels between `root` and the archive, and no others. The name holds a hash of
    the whole path below `root` and the member, so equal names in different folders stay apart.
    """
    below = uri.removeprefix(root).strip("/")
    levels = [level for level in below.split("/")[:-1] if "=" in level]
    mark = hashlib.sha256(f"{below}\0{member}".encode()).hexdigest()[:_MARK_LENGTH]
    return "/".join(levels), f"{mark}-{member.rsplit('/', 1)[-1]}"


def pack_by_bytes(members: DataFrame, cores: int) -> DataFrame:
    """`members` (path, member, size) dealt out to tasks of about equal bytes, one member at least.

    One row per member passes through one task for the running sum; contents do not.
    """
    total, count = members.agg(F.sum(F.col("size") + 1), F.count("*")).first()
    share = max(math.ceil(total / _MOST_TASKS), min(_TASK_BYTES, math.ceil(total / max(1, cores))))
    before = F.sum(F.col("size") + 1).over(Window.orderBy("path", "member").rowsBetween(Window.unboundedPreceding, -1))
    dealt = members.withColumn("task", F.floor(F.coalesce(before, F.lit(0)) / share))
    return dealt.repartitionByRange(min(count, math.ceil(total / share)), "task").drop("task")


def _extract_into(staging: str, root: str):
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target_fs, target_root = open_filesystem(staging)
        for batch in batches:
            marks, sources = [], []
            for row in batch.to_pylist():
                levels, name = staged_place(root, row["path"], row["member"])
                folder = f"{target_root}/{levels}".rstrip("/")
                source_fs, path = open_filesystem(row["path"])
                with source_fs.open_input_file(path) as raw, zipfile.ZipFile(raw) as archive:
                    with archive.open(row["member"]) as member, write_file(target_fs, folder, name) as out:
                        shutil.copyfileobj(member, out, _COPY_BYTES)
                marks.append(name[:_MARK_LENGTH])
                sources.append(f"{row['path']}!{row['member']}")
            yield pa.RecordBatch.from_pydict({"mark": pa.array(marks, pa.string()), "source": pa.array(sources, pa.string())})

    return extract


def read_zip_csv(
    spark: SparkSession,
    root: str,
    options: Mapping[str, str] | None = None,
    archives: DataFrame | None = None,
    source_file: str = "",
) -> DataFrame:
    """Unpack all archives below `root` and read the members as CSV with the given reader options.

    `archives` (path) names those to read instead. `source_file` names a column that says for each row the
    archive and, after an exclamation mark, the member it comes from.

    Tasks unpack archive members, packed by their unpacked size, as streams into the shared folder under
    the same Hive folders. The text read back from there splits, so one huge member does not stay in one task.
    """
    archives = list_files(spark, root, ".zip").select("path") if archives is None else archives.select("path")
    count = archives.count()
    if not count:
        raise FileNotFoundError(f"no zip archives in {root}")
    listing = archives.repartition(min(_MOST_TASKS, math.ceil(count / _ARCHIVES_PER_TASK)))
    members = stage(listing.mapInArrow(_list_members, "path string, member string, size long"))
    total = members.count()
    if not total:
        raise FileNotFoundError(f"the archives in {root} are empty")
    staging = qualified(spark, new_path(spark, "unzipped"))
    packed = pack_by_bytes(members, spark.sparkContext.defaultParallelism)
    written = stage(packed.mapInArrow(_extract_into(staging, qualified(spark, root)), "mark string, source string"), "members")
    rows = spark.read.options(**(options or {})).csv(staging)
    if not source_file:
        return rows
    mark = fresh_name(rows.columns, "_mark")
    named = broadcast_if_small(written.select(F.col("mark").alias(mark), F.col("source").alias(source_file)))
    marked = rows.select("*", F.substring("_metadata.file_name", 1, _MARK_LENGTH).alias(mark))
    return marked.join(named, mark).drop(mark)
