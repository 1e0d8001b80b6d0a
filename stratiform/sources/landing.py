"""Land a new batch under segment=/year=/month=/day=/load= of the run time."""

from __future__ import annotations

import uuid
import zipfile
from collections.abc import Iterator, Mapping
from datetime import datetime, timezone
from itertools import chain

import pyarrow as pa
import pyarrow.csv as pa_csv
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.sources.files import open_filesystem, write_file
from stratiform.spec import LOAD_COLUMNS
from stratiform.workspace import qualified

# Level of the archives' compression: half the time of the default for files a twentieth larger.
_COMPRESSION = 4

# Delimited text is landed with all six digits of a second.
_TEXT_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def load_values(segment: str, run_time: datetime) -> dict[str, str]:
    """Folder values of a run, in UTC and zero-padded; the load is the time of day to the microsecond."""
    utc = run_time.astimezone(timezone.utc)
    formats = ("%Y", "%m", "%d", "%H%M%S%f")
    return dict(zip(LOAD_COLUMNS, (segment, *(utc.strftime(f) for f in formats)), strict=True))


def land_batch(
    df: DataFrame,
    root: str,
    segment: str,
    run_time: datetime,
    format: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> str:
    """Append the rows as one load folder below `root` and return the folder. No shuffle.

    Format "zip_csv" writes standard CSV (quotes doubled, read with the option escape='"') into archives.
    """
    values = load_values(segment, run_time)
    folder = "/".join([root.rstrip("/"), *(f"{name}={value}" for name, value in values.items())])
    if format == "zip_csv":
        _write_zips(df, folder)
    else:
        defaults = _TEXT_OPTIONS if format == "csv" else {}
        df.write.format(format).options(**{**defaults, **(options or {})}).mode("append").save(folder)
    return folder


def land_archive(df: DataFrame, folder: str, name: str, member: str) -> None:
    """Write the rows into the members `member` of the archives `name`.zip, one folder per partition below `folder`."""
    _write_zips(df, folder, name, member)


def _write_zips(df: DataFrame, folder: str, fixed_name: str = "", fixed_member: str = "") -> None:
    """One archive with one CSV member per partition, streamed batch by batch.

    With a fixed name, archives are told apart by a folder for each partition.
    """
    batch_id = uuid.uuid4().hex
    folder = qualified(df.sparkSession, folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        filesystem, path = open_filesystem(folder)
        name = f"part-{TaskContext.get().partitionId():05d}-{batch_id}"
        if fixed_name:
            path, name = f"{path}/{name[:10]}", fixed_name
        with (
            write_file(filesystem, path, f"{name}.zip") as raw,
            zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED, compresslevel=_COMPRESSION) as archive,
            archive.open(fixed_member or f"{name}.csv", "w", force_zip64=True) as member,
        ):
            for batch in chain([first], batches):
                pa_csv.write_csv(batch, member, pa_csv.WriteOptions(include_header=batch is first))
                yield pa.RecordBatch.from_pydict({"rows": pa.array([batch.num_rows], pa.int64())})

    df.mapInArrow(write, "rows bigint").agg(F.sum("rows")).collect()
