"""Size-checked broadcasts and left lookups into a dimension."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
_FIXED_WIDTH_BYTES = 16


def _width(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)) + _FIXED_WIDTH_BYTES
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0)) + _FIXED_WIDTH_BYTES
    return F.lit(_FIXED_WIDTH_BYTES)


def fits_broadcast(
    df: DataFrame, *column_sets: Sequence[str], limit_bytes: int = BROADCAST_LIMIT_BYTES
) -> list[bool]:
    """Measure for each set of columns whether all rows of `df` fit the limit.

    Meant for scans of written tables: the row count comes from file footers and settles large tables,
    so only a table that may fit is read.
    """
    rows = df.count()
    open_sets = [c for c in column_sets if rows * _FIXED_WIDTH_BYTES * len(c) <= limit_bytes]
    if not open_sets:
        return [False] * len(column_sets)
    sizes = df.agg(
        *[
            F.sum(sum((_width(df.schema[c]) for c in columns), F.lit(0)).cast("bigint")).alias(f"size{i}")
            for i, columns in enumerate(open_sets)
        ]
    ).first()
    fitting = [c for c, size in zip(open_sets, sizes, strict=True) if (size or 0) <= limit_bytes]
    return [c in fitting for c in column_sets]


def broadcast_if_small(df: DataFrame, limit_bytes: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Hint a broadcast when `df` was measured to fit; otherwise leave the join to a skew-aware shuffle."""
    (fits,) = fits_broadcast(df, df.columns, limit_bytes=limit_bytes)
    return F.broadcast(df) if fits else df


def lookup_keys(
    facts: DataFrame,
    dimension: DataFrame,
    natural_key: str,
    surrogate_key: str,
    roles: Mapping[str, str],
    limit_bytes: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """Left-join one dimension once per role; `roles` maps fact column -> name of the added key.

    Unmatched and NULL values keep their row with a NULL key. Several dimension rows for one natural
    key give several output rows, as a plain left join does.
    """
    pair = broadcast_if_small(dimension.select(natural_key, surrogate_key), limit_bytes)
    for column, added in roles.items():
        side = pair.select(
            F.col(natural_key).alias(f"_{added}_on"),
            F.col(surrogate_key).alias(added),
        )
        facts = facts.join(side, F.col(column) == F.col(f"_{added}_on"), "left").drop(f"_{added}_on")
    return facts
