"""Upsert as plain joins, for tables whose format has no row-level MERGE."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratiform.operators.dedupe import frequent_keys, orderable
from stratiform.operators.lookup import BROADCAST_LIMIT_BYTES, fits_broadcast
from stratiform.workspace import fresh_name

#: Rows of one key that a task may take whole.
HOT_KEY_ROWS = 100_000


def _all_present(keys: Sequence[str]) -> Column:
    return reduce(and_, (F.col(f"`{k}`").isNotNull() for k in keys))


def check_merge_columns(
    target: DataFrame, source: DataFrame, keys: Sequence[str], newest_by: Sequence[str] = (), surrogate_key: str = ""
) -> None:
    if not keys:
        raise ValueError("a merge needs at least one key column")
    unknown = [c for c in source.columns if c not in target.columns]
    if unknown:
        raise ValueError(f"the target has no column {', '.join(unknown)}")
    missing = [c for c in newest_by if c not in source.columns or c in (*keys, surrogate_key)]
    if missing:
        raise ValueError(f"no source column to compare the age of rows by: {', '.join(missing)}")


def as_target_types(source: DataFrame, target: DataFrame) -> DataFrame:
    """The source with the column types of the target, which keeps the types it was created with."""
    types = {f.name: f.dataType for f in target.schema.fields}
    changed = {f.name: types[f.name] for f in source.schema.fields if f.dataType != types[f.name]}
    return source.withColumns({name: F.col(f"`{name}`").cast(t) for name, t in changed.items()}) if changed else source


def check_single_match(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> None:
    """Raise when several source rows would update the same target row."""
    names = [f"`{k}`" for k in keys]
    repeated = source.filter(_all_present(keys)).groupBy(*names).count().filter("count > 1").select(*names)
    if repeated.isEmpty():
        return
    clash = repeated.join(target.select(*names), list(keys), "left_semi").limit(1).collect()
    if clash:
        raise ValueError(f"several source rows match one target row: {clash[0].asDict()}")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    surrogate_key: str,
    newest_by: Sequence[str] = (),
    source_is_unique: bool = False,
    limit_bytes: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """The target after the merge.

    Rows equal on all keys take every source column but the surrogate key; other source rows are
    inserted; other target rows stay. NULL keys equal nothing, so both sides keep theirs. With
    `newest_by`, a match only updates when the source is not older on those columns.

    Both inputs should be scans of written tables, since each is read more than once. When the source,
    or just its keys, was measured to fit a broadcast, the target is not shuffled for that join. When
    not, a left and an anti join take the place of a full outer one, because Spark can split a hot key
    of the target at run time only in the former. Both then read the same shuffle of the source.
    """
    check_merge_columns(target, source, keys, newest_by, surrogate_key)
    source = as_target_types(source, target)
    if not source_is_unique:
        check_single_match(target, source, keys)

    names = [f"`{k}`" for k in keys]
    payload = [c for c in source.columns if c not in keys and c != surrogate_key]
    keys_fit, rows_fit = fits_broadcast(source, list(keys), source.columns, limit_bytes=limit_bytes)
    matchable = source.filter(_all_present(keys))

    # Every target row, changed where the source has its key. All columns of the source go to the join as they are,
    # so that its shuffle is the same as that of the join below, and is done once.
    ours = {c: f"_t{i}" for i, c in enumerate(target.columns)}
    renamed = target.select(*[F.col(f"`{c}`").alias(ours[c]) for c in target.columns])
    match = reduce(and_, (F.col(ours[k]) == F.col(f"`{k}`") for k in keys))
    rest = [c for c in source.columns if c not in keys and c not in payload]
    takes = reduce(or_, (F.col(f"`{c}`").isNotNull() for c in [keys[0], *rest]))
    if newest_by:
        held = [F.col(ours[c]).alias(c) for c in newest_by]
        takes &= F.struct(*[F.col(f"`{c}`") for c in newest_by]) >= F.struct(*held)
    changed = {c: F.when(takes, F.col(f"`{c}`")).otherwise(F.col(ours[c])) for c in payload}
    kept = renamed.join(F.broadcast(matchable) if rows_fit else matchable, match, "left").select(
        *[changed.get(c, F.col(ours[c])).alias(c) for c in target.columns]
    )

    # Source rows whose key the target lacks or which have none. Only the key columns of the target are read for
    # this, and a hot key of the target is down to one row per task before it is shuffled.
    known = target.filter(_all_present(keys)).select(*names)
    if keys_fit:
        known = F.broadcast(known.join(F.broadcast(matchable.select(*names)), list(keys), "left_semi").distinct())
    else:
        known = known.distinct()
    new = matchable.join(known, list(keys), "left_anti")
    inserted = new.unionByName(source.filter(~_all_present(keys)))
    return kept.unionByName(inserted, allowMissingColumns=True)


def has_hot_key(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether a key without NULLs has so many rows that one task should not take them all."""
    present = df.filter(_all_present(keys))
    key = F.xxhash64(*[f"`{k}`" for k in keys])
    counted = present.where(key.isin(frequent_keys(present, keys))).groupBy(key).count()
    return (counted.agg(F.max("count")).first()[0] or 0) > HOT_KEY_ROWS


def upsert_by_range(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    surrogate_key: str,
    newest_by: Sequence[str] = (),
    source_is_unique: bool = False,
    within: Sequence[str] = (),
) -> DataFrame:
    """As `upsert`, by one shuffle of both inputs, whose partitions are ranges of the columns `within` and the keys.

    `within` depends on the keys alone. All rows of a key come to one task, so inputs with a hot key (`has_hot_key`)
    are for `upsert`. Rows without a key are spread over tasks.
    """
    check_merge_columns(target, source, keys, newest_by, surrogate_key)
    source = as_target_types(source, target)
    if not source_is_unique:
        check_single_match(target, source, keys)
    payload = [c for c in source.columns if c not in (*keys, *within, surrogate_key)]
    given, spread, first, held = (fresh_name(target.columns, n) for n in ("_given", "_spread", "_first", "_held"))
    present, is_given = _all_present(keys), F.col(given)

    both = target.withColumn(given, F.lit(False)).unionByName(source.withColumn(given, F.lit(True)), True)
    apart = F.xxhash64(*[f"`{f.name}`" for f in target.schema.fields if orderable(f.dataType)])
    both = both.withColumn(spread, F.when(present, F.lit(0).cast("bigint")).otherwise(apart))
    group = [*[f"`{c}`" for c in (*within, *keys)], spread]
    whole = Window.partitionBy(*group).orderBy(is_given.desc())
    whole = whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    fields = {c: f"_{i}" for i, c in enumerate(payload)}
    values = F.struct(is_given.alias("given"), *[F.col(f"`{c}`").alias(n) for c, n in fields.items()])
    met = both.repartitionByRange(*group).withColumns(
        {first: F.first(values).over(whole), held: F.max(~is_given).over(whole)}
    )

    # The source row of a key comes first; it stays where the target has no row of that key.
    takes = present & ~is_given & F.col(first)["given"]
    if newest_by:
        theirs = F.struct(*[F.col(first)[fields[c]].alias(c) for c in newest_by])
        takes &= theirs >= F.struct(*[F.col(f"`{c}`") for c in newest_by])
    changed = {c: F.when(takes, F.col(first)[n]).otherwise(F.col(f"`{c}`")) for c, n in fields.items()}
    stays = ~(present & is_given & F.col(held))
    return met.where(stays).select(*[changed.get(c, F.col(f"`{c}`")).alias(c) for c in target.columns])
