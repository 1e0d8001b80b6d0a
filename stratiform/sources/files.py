"""Listing files with Spark and opening them inside tasks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import NativeFile, fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Hadoop names of file systems that Arrow knows by another name.
_ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def list_files(spark: SparkSession, root: str, suffix: str) -> DataFrame:
    """(path, length) of every file below `root` whose lower-cased name ends with `suffix`.

    Spark lists the folders; no file is opened, because the content column is not selected.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path", "length")
        .filter(F.lower("path").endswith(suffix.lower()))
    )


def open_filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path for a full URI; for use inside tasks."""
    scheme, colon, rest = uri.partition(":")
    if not colon:
        raise ValueError(f"not a full URI: {uri}")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"{_ARROW_SCHEMES.get(scheme, scheme)}:{rest}")


@contextmanager
def write_file(filesystem: fs.FileSystem, folder: str, name: str) -> Iterator[NativeFile]:
    """Write `folder/name` under a hidden name and move it into place when complete.

    Readers never see a partial file, and a repeated task attempt replaces the file with equal content.
    """
    filesystem.create_dir(folder, recursive=True)
    partial = f"{folder}/.{name}.{uuid.uuid4().hex}.part"
    with filesystem.open_output_stream(partial) as out:
        yield out
    filesystem.move(partial, f"{folder}/{name}")
