"""Shared scratch space: where intermediate tables are written between jobs.

Everything lives below the folder the cluster names in ``spark.checkpoint.dir``, so what was staged
outlives any executor. A session that names none stages in its warehouse, where managed tables live already.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from weakref import WeakSet

from pyspark.sql import DataFrame, SparkSession

_written: WeakSet[DataFrame] = WeakSet()
_open_scope: ContextVar[list[str] | None] = ContextVar("stratiform_staged_paths", default=None)


def shared_root(spark: SparkSession) -> str:
    """The shared folder of this session."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (root or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/staged").rstrip("/")


def new_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder; removed at the end of the enclosing scope, if any."""
    path = f"{shared_root(spark)}/{spark.sparkContext.applicationId}/{purpose}-{uuid.uuid4().hex}"
    scope = _open_scope.get()
    if scope is not None:
        scope.append(path)
    return path


def stage(df: DataFrame, purpose: str = "stage") -> DataFrame:
    """Write `df` to the shared folder and return a scan of what was written.

    The scan has no lineage, costs no recomputation however often it is used, and prunes columns.
    """
    path = new_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return as_written(df.sparkSession.read.schema(df.schema).parquet(path))


def as_written(df: DataFrame) -> DataFrame:
    """`df`, noted as made of what was written: reading it again costs a scan and gives the same rows."""
    _written.add(df)
    return df


def is_written(df: DataFrame) -> bool:
    return df in _written


@contextmanager
def staging_scope(spark: SparkSession) -> Iterator[None]:
    """Remove everything staged inside the block when it ends."""
    paths: list[str] = []
    token = _open_scope.set(paths)
    try:
        yield
    finally:
        _open_scope.reset(token)
        for path in paths:
            remove_path(spark, path)


def keep_path(path: str) -> None:
    """Exempt a path from removal at the end of the enclosing scope."""
    scope = _open_scope.get()
    if scope is not None and path in scope:
        scope.remove(path)


def fresh_name(columns: Sequence[str], name: str) -> str:
    """`name`, with underscores in front until no column is called so."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def qualified(spark: SparkSession, path: str) -> str:
    """The full URI of a path as Spark understands it, for code that opens it without Spark."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(target).toString()


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system Spark itself uses for it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
