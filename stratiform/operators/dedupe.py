"""Keep the newest delivery of each row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.spec import LOAD_COLUMNS, RECENCY_COLUMNS
from stratiform.workspace import fresh_name

#: Share of all rows from which on a key is taken out of shuffles that send a key to one task.
FREQUENT_SHARE = 0.01


def dedupe_key(df: DataFrame, business_key: Sequence[str], beside: Sequence[str] = ()) -> list[str]:
    """The business key, or the whole row without its load columns and those of `beside` where there is none."""
    return list(business_key) or [c for c in df.columns if c not in (*LOAD_COLUMNS, *beside)]


def orderable(kind: T.DataType) -> bool:
    """Whether Spark can compare values of a type: not maps and variants, nor what holds one."""
    if isinstance(kind, T.ArrayType):
        return orderable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(orderable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))


def keep_newest(df: DataFrame, business_key: Sequence[str] = (), beside: Sequence[str] = ()) -> DataFrame:
    """One row per key: the one of the newest load. NULL keys count as equal; columns of `beside` are no key.

    Equal loads are settled by the remaining columns, so a re-run picks the same row. Each task keeps
    one row per key before the shuffle (the optimizer turns the rank filter into a group limit on both
    sides of the exchange), so a key that fills a third of the input sends one row per task.
    """
    key = dedupe_key(df, business_key, beside)
    ties = [f.name for f in df.schema.fields if f.name not in (*key, *RECENCY_COLUMNS) and orderable(f.dataType)]
    newest_first = [F.col(f"`{c}`").desc() for c in (*RECENCY_COLUMNS, *ties)]
    rank = F.row_number().over(Window.partitionBy(*[f"`{c}`" for c in key]).orderBy(*newest_first))
    name = fresh_name(df.columns, "_rank")
    return df.withColumn(name, rank).filter(F.col(name) == 1).drop(name)


def frequent_keys(df: DataFrame, keys: Sequence[str]) -> list[int]:
    """Hashes of keys, among them those of every key that holds more than `FREQUENT_SHARE` of the rows.

    Others may be among them. At most 1 / `FREQUENT_SHARE` numbers reach the driver.
    """
    marked = df.select(F.xxhash64(*[f"`{k}`" for k in keys]).alias("key"))
    return list(marked.stat.freqItems(["key"], FREQUENT_SHARE).first()[0] or [])


def newest_in_order(df: DataFrame, business_key: Sequence[str]) -> DataFrame:
    """`keep_newest` with its rows ranged by the business key: `number_rows(..., ranged=True)` shuffles no more.

    One shuffle by ranges of the key serves the dedupe and the order. It sends all rows of a key to one task, so
    keys that may be frequent are reduced by `keep_newest` before. Which these are decides on the way of a row,
    not on the result. The input is read several times and should be a scan.
    """
    names = [f"`{k}`" for k in business_key]
    frequent = F.xxhash64(*names).isin(frequent_keys(df, business_key))
    rows = df.where(~frequent).unionByName(keep_newest(df.where(frequent), business_key))
    return keep_newest(rows.repartitionByRange(*names), business_key)
