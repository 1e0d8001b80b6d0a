"""Append, replace and merge into catalog tables."""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.operators.lookup import fits_broadcast
from stratiform.operators.merge import (
    as_target_types,
    check_merge_columns,
    check_single_match,
    has_hot_key,
    upsert,
    upsert_by_range,
)
from stratiform.spec import EntitySpec
from stratiform.workspace import is_written, keep_path, new_path, remove_path, stage, staging_scope

log = logging.getLogger(__name__)

DEFAULT_FORMAT = "parquet"

#: Partition column of tables whose merges rewrite only the buckets they touch, and of tables appended by batch.
KEY_BUCKET = "key_bucket"
LOAD_BATCH = "load_batch"

# Table properties that say how rows are dealt to buckets.
_BUCKET_COUNT, _BUCKET_KEYS = "stratiform.key_buckets", "stratiform.bucket_keys"

# Small files a bucket may have on average before a merge gathers them.
_SMALL_FILES, _SMALL_FILE_BYTES = 4, 16 * 1024 * 1024

# Table formats whose catalogs carry out a row-level MERGE themselves.
ROW_LEVEL_FORMATS = ("delta", "iceberg")


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def _detail(spark: SparkSession, table: str, item: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    return rows.filter(F.col("col_name") == item).first()["data_type"]


def _version_path(spark: SparkSession, table: str) -> str:
    database, name = table.rsplit(".", 1) if "." in table else (spark.catalog.currentDatabase(), table)
    location = spark.catalog.getDatabase(database).locationUri.rstrip("/")
    return f"{location}/{name}/version-{uuid.uuid4().hex}"


def append_table(df: DataFrame, table: str, format: str = DEFAULT_FORMAT) -> None:
    """Append by column name; the first append creates the table."""
    writer = df.write.format(format).mode("append")
    if format not in ROW_LEVEL_FORMATS and not table_exists(df.sparkSession, table):
        writer = writer.option("path", _version_path(df.sparkSession, table))
    writer.saveAsTable(table)


def append_batch(df: DataFrame, table: str, batch: str, format: str = DEFAULT_FORMAT) -> bool:
    """Append the rows of one batch unless the table has that batch already; returns whether it was written.

    The batch's name is the partition its rows go to, so rows and name are committed together. A write that
    broke off before its commit left nothing that readers see, and is replaced by the next attempt. The
    first batch creates the table. Columns are matched by name; the table's other columns are NULL.
    """
    spark = df.sparkSession
    marked = df.withColumn(LOAD_BATCH, F.lit(batch))
    if not table_exists(spark, table):
        writer = marked.write.format(format).partitionBy(LOAD_BATCH).option("path", _version_path(spark, table))
        writer.saveAsTable(table)
        return True
    if batch_is_there(spark, table, batch):
        return False
    target = spark.table(table)
    unknown = [c for c in marked.columns if c not in target.columns]
    if unknown:
        raise ValueError(f"the target has no column {', '.join(unknown)}")
    rows, columns = as_target_types(marked, target), [c for c in target.columns if c != LOAD_BATCH]
    aligned = rows.select(*[F.col(f"`{c}`") if c in rows.columns else F.lit(None).alias(c) for c in columns])
    view = f"batch_{uuid.uuid4().hex}"
    aligned.createOrReplaceTempView(view)
    try:
        # One named partition is replaced, whatever the session's overwrite mode.
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({LOAD_BATCH}='{batch}') SELECT * FROM {view}")
    finally:
        spark.catalog.dropTempView(view)
    spark.catalog.refreshTable(table)
    return True


def batch_is_there(spark: SparkSession, table: str, batch: str) -> bool:
    """Whether `append_batch` has committed this batch."""
    if not table_exists(spark, table):
        return False
    if LOAD_BATCH not in spark.table(table).columns:
        raise ValueError(f"{table} was not created by batches: it has no column {LOAD_BATCH}")
    return not spark.sql(f"SHOW PARTITIONS {table} PARTITION ({LOAD_BATCH}='{batch}')").isEmpty()


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _overwrite_partitions(
    spark: SparkSession, path: str, folder: str, rows: DataFrame, format: str, table: str, buckets: Sequence[int]
) -> None:
    """Move the buckets written at `path` to `folder`, among the versions of `table`, and point its partitions there.

    Nothing is written again unless the two are on different file systems. The old files stay, so readers see a
    bucket as it was or as it is.
    """
    (old, here), (new, there) = _file_system(spark, path), _file_system(spark, folder)
    if here.getUri().toString() == there.getUri().toString() and here.getScheme() != "viewfs":
        there.mkdirs(new.getParent())
        if not here.rename(old, new):
            raise OSError(f"{path} could not be moved to {folder}")
    else:
        written = spark.read.format(format).schema(rows.schema).load(path).hint("rebalance", KEY_BUCKET)
        written.write.format(format).partitionBy(KEY_BUCKET).save(folder)
    known = {r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    for bucket in buckets:
        name, location = f"{KEY_BUCKET}={bucket}", f"'{folder}/{KEY_BUCKET}={bucket}'"
        if name in known:
            spark.sql(f"ALTER TABLE {table} PARTITION ({name}) SET LOCATION {location}")
        else:
            spark.sql(f"ALTER TABLE {table} ADD PARTITION ({name}) LOCATION {location}")
    spark.catalog.refreshTable(table)


def replace_table(df: DataFrame, table: str, format: str = DEFAULT_FORMAT) -> None:
    """Replace the whole content. `df` may read the table that is being replaced.

    The rows are written to a new folder and the table is pointed at it last, so readers see the old or
    the new content, and a failed job leaves the table as it was. Where the columns change, the new
    definition is created under another name and the two names are swapped: between the two renames the
    name is briefly missing, but the old table is there under its other name and is put back if the second
    fails. The old folder stays for readers still using it until `drop_old_versions`.
    """
    spark = df.sparkSession
    if format in ROW_LEVEL_FORMATS:
        df.write.format(format).mode("overwrite").option("overwriteSchema", "true").saveAsTable(table)
        return
    path = _version_path(spark, table)
    df.write.format(format).save(path)
    columns = [(f.name, f.dataType) for f in df.schema.fields]
    if table_exists(spark, table):
        present = [(f.name, f.dataType) for f in spark.table(table).schema.fields]
        if present == columns and _detail(spark, table, "Provider").lower() == format:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
            spark.catalog.refreshTable(table)
            return
        _swap_definition(spark, table, path, format, df)
        return
    spark.catalog.createTable(table, path=path, source=format, schema=df.schema)


def _swap_definition(spark: SparkSession, table: str, path: str, format: str, df: DataFrame) -> None:
    mark = uuid.uuid4().hex[:12]
    new, old = f"{table}__new_{mark}", f"{table}__old_{mark}"
    spark.catalog.createTable(new, path=path, source=format, schema=df.schema)
    spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
    except Exception:
        spark.sql(f"ALTER TABLE {old} RENAME TO {table}")
        spark.sql(f"DROP TABLE IF EXISTS {new}")
        raise
    spark.sql(f"DROP TABLE {old}")
    spark.catalog.refreshTable(table)


def drop_old_versions(spark: SparkSession, table: str) -> int:
    """Remove the folders a replaced or merged table no longer uses; returns how many.

    Run it when no job is reading an older version or writing a new one.
    """
    current = _detail(spark, table, "Location").rstrip("/")
    parent, name = current.rsplit("/", 1)

    def inside(folder: str) -> list[str]:
        place, system = _file_system(spark, folder)
        return [status.getPath().getName() for status in system.listStatus(place) if status.isDirectory()]

    versions = [n for n in inside(parent) if n.startswith("version-")]
    if KEY_BUCKET in spark.table(table).columns:
        # A bucket is in the version of the merge that last touched it. One short path per bucket reaches the driver.
        used = spark.table(table).select(F.regexp_extract("_metadata.file_path", r"([^/]+/[^/]+)/[^/]+$", 1)).distinct()
        kept = {r[0] for r in used.collect()}
        old = []
        for version in versions:
            if version == name or any(k.startswith(f"{version}/") for k in kept):
                buckets = [f"{version}/{b}" for b in inside(f"{parent}/{version}") if b.startswith(f"{KEY_BUCKET}=")]
                old += [b for b in buckets if b not in kept]
            else:
                old.append(version)
    else:
        old = [v for v in versions if v != name]
    for unused in old:
        remove_path(spark, f"{parent}/{unused}")
    return len(old)


def merge_table(
    source: DataFrame,
    table: str,
    keys: Sequence[str],
    surrogate_key: str,
    newest_by: Sequence[str] = (),
    source_is_unique: bool = False,
    format: str = DEFAULT_FORMAT,
    source_is_written: bool = False,
    key_buckets: int = 0,
) -> None:
    """Upsert into `table`; the first merge creates it. Matched rows keep their surrogate key.

    The source is read several times, so unless it is a scan of something written it is staged first: it
    is evaluated once, and one evaluation decides what is updated and what is inserted.

    With `key_buckets` the table is created with its rows dealt by a hash of the keys to that many partitions
    (column `key_bucket`). Its merges then read and rewrite only the partitions that the source has keys of.
    """
    if not keys:
        raise ValueError("a merge needs at least one key column")
    spark = source.sparkSession
    if not table_exists(spark, table):
        if key_buckets and format not in ROW_LEVEL_FORMATS:
            _create_bucketed(source, table, keys, key_buckets, format)
        else:
            append_table(source, table, format)
        return
    provider = _detail(spark, table, "Provider").lower()
    with staging_scope(spark):
        written = source if source_is_written or is_written(source) else stage(source, "merge_source")
        if provider in ROW_LEVEL_FORMATS:
            _merge_row_level(written, table, keys, surrogate_key, newest_by, source_is_unique)
            return
        buckets = _bucketing(spark, table)
        if buckets:
            _merge_touched(written, table, keys, surrogate_key, newest_by, source_is_unique, provider, *buckets)
            return
        merged = upsert(spark.table(table), written, keys, surrogate_key, newest_by, source_is_unique)
        replace_table(merged, table, provider)


def _in_bucket(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    return df.withColumn(KEY_BUCKET, F.pmod(F.xxhash64(*[f"`{k}`" for k in keys]), F.lit(buckets)).cast("int"))


def _create_bucketed(source: DataFrame, table: str, keys: Sequence[str], buckets: int, format: str) -> None:
    spark = source.sparkSession
    if KEY_BUCKET in source.columns:
        raise ValueError(f"the column {KEY_BUCKET} is taken")
    dealt = _in_bucket(source, keys, buckets).hint("rebalance", KEY_BUCKET)
    dealt.write.format(format).partitionBy(KEY_BUCKET).option("path", _version_path(spark, table)).saveAsTable(table)
    names = json.dumps(list(keys)).replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{_BUCKET_COUNT}' = '{buckets}', '{_BUCKET_KEYS}' = '{names}')")


def _bucketing(spark: SparkSession, table: str) -> tuple[list[str], int] | None:
    """The keys a table's rows are dealt by and the number of buckets; none for other tables."""
    held = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    if _BUCKET_COUNT not in held:
        if KEY_BUCKET in spark.table(table).columns:
            raise ValueError(f"{table} has a column {KEY_BUCKET} but no property {_BUCKET_COUNT}")
        return None
    return json.loads(held[_BUCKET_KEYS]), int(held[_BUCKET_COUNT])


def _merge_touched(
    source: DataFrame,
    table: str,
    keys: Sequence[str],
    surrogate_key: str,
    newest_by: Sequence[str],
    source_is_unique: bool,
    format: str,
    bucket_keys: Sequence[str],
    buckets: int,
) -> None:
    """Upsert within the partitions that hold the source's keys, which are then pointed at what was written.

    The merged rows are written once, by bucket, to the shared folder, and moved from there. If that fails on the
    way, the error names the place they are at; no old file is removed, and merging once more repairs the table.

    A source that fits a broadcast leaves the other rows in the order of their files, so nothing is shuffled,
    unless these files are many and small. Else both sides go through one shuffle, by ranges of bucket and keys.
    """
    if list(bucket_keys) != list(keys):
        raise ValueError(f"{table} is dealt to buckets by {', '.join(bucket_keys)}, not by {', '.join(keys)}")
    spark = source.sparkSession
    target = spark.table(table)
    check_merge_columns(target, source, keys, newest_by, surrogate_key)
    dealt = _in_bucket(as_target_types(source, target), keys, buckets)
    # At most one number per bucket.
    touched = sorted(r[0] for r in dealt.select(KEY_BUCKET).distinct().collect())
    if not touched:
        return
    log.info("%s: %d of %d buckets are rewritten", table, len(touched), buckets)
    part = target.where(F.col(KEY_BUCKET).isin(touched))
    (small,) = fits_broadcast(dealt, dealt.columns)
    names = [f"`{k}`" for k in keys]
    if small:
        # One task per bucket writes its new rows.
        dealt = stage(dealt.repartition(KEY_BUCKET), "merge_source")
    if small or has_hot_key(part.select(*names).union(dealt.select(*names)), keys):
        merged = upsert(part, dealt, keys, surrogate_key, newest_by, source_is_unique)
        if not small or _in_small_files(part, len(touched)):
            merged = merged.hint("rebalance", KEY_BUCKET)
    else:
        merged = upsert_by_range(part, dealt, keys, surrogate_key, newest_by, source_is_unique, [KEY_BUCKET])
    path, folder = new_path(spark, "merged_buckets"), _version_path(spark, table)
    merged.write.format(format).partitionBy(KEY_BUCKET).save(path)
    try:
        _overwrite_partitions(spark, path, folder, merged, format, table, touched)
    except Exception as error:
        place, system = _file_system(spark, path)
        kept = path if system.exists(place) else folder
        keep_path(path)
        raise RuntimeError(f"merging into {table} broke off; the new rows of its partitions are in {kept}") from error


def _in_small_files(part: DataFrame, buckets: int) -> bool:
    """Whether the buckets have more small files than merges should leave behind."""
    files = part.select("_metadata.file_path", "_metadata.file_size").distinct()
    return files.where(F.col("file_size") < _SMALL_FILE_BYTES).count() > _SMALL_FILES * buckets


def _merge_row_level(
    source: DataFrame,
    table: str,
    keys: Sequence[str],
    surrogate_key: str,
    newest_by: Sequence[str],
    source_is_unique: bool,
) -> None:
    target = source.sparkSession.table(table)
    check_merge_columns(target, source, keys, newest_by, surrogate_key)
    if not source_is_unique:
        check_single_match(target, source, keys)
    match = reduce(and_, (F.col(f"{table}.{k}") == F.col(f"source.{k}") for k in keys))
    update = {c: F.col(f"source.{c}") for c in source.columns if c != surrogate_key}
    takes = None
    if newest_by:
        takes = F.struct(*[f"source.{c}" for c in newest_by]) >= F.struct(*[f"{table}.{c}" for c in newest_by])
    merge = source.alias("source").mergeInto(table, match)
    merge.whenMatched(takes).update(update).whenNotMatched().insert(
        {c: F.col(f"source.{c}") for c in source.columns}
    ).merge()


Writer = Callable[[DataFrame, EntitySpec], None]


def _write_append(df: DataFrame, spec: EntitySpec) -> None:
    append_table(df, spec.destination)


def _write_merge(df: DataFrame, spec: EntitySpec) -> None:
    # The default transform leaves one written row per business key; any other is staged and checked.
    default = spec.custom_transform == "default"
    merge_table(
        df,
        spec.destination,
        spec.business_key,
        spec.surrogate_key,
        source_is_unique=default,
        source_is_written=default,
        key_buckets=spec.key_buckets,
    )


# The load types entity specifications use.
WRITERS: dict[str, Writer] = {"append": _write_append, "merge": _write_merge}


def register_writer(name: str, writer: Writer) -> None:
    WRITERS[name] = writer


def write_entity(df: DataFrame, spec: EntitySpec) -> None:
    if spec.load_type not in WRITERS:
        raise ValueError(f"unsupported load type: {spec.load_type}")
    WRITERS[spec.load_type](df, spec)
