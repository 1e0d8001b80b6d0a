"""Projection, type overrides and audit columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep the named columns; an empty list keeps all."""
    return df.select(*columns) if columns else df


# Text without a digit that still reads as a number: infinities and NaN.
_MAYBE_NUMBER = "[0-9]|(?i:inf|nan)"
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)
_INTEGER_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}


def _cast(df: DataFrame, name: str, type_name: str, strict: bool) -> Column:
    column = F.col(f"`{name}`")
    if strict:
        return column.cast(type_name)
    lenient = column.try_cast(type_name)
    given, wanted = (f.dataType for f in df.select(column, lenient.alias("wanted")).schema.fields)
    # Each value that fails to cast costs an exception, so those that plainly cannot are passed over first.
    if isinstance(given, T.StringType) and isinstance(wanted, _FRACTIONAL):
        return F.when(column.rlike(_MAYBE_NUMBER), lenient)
    if _INTEGER_BITS.get(type(wanted), 64) < _INTEGER_BITS.get(type(given), 0):
        largest = 1 << (_INTEGER_BITS[type(wanted)] - 1)
        return F.when(column.between(-largest, largest - 1), lenient)
    return lenient


def override_types(df: DataFrame, types: Mapping[str, str], strict: bool = True) -> DataFrame:
    """Cast each listed column. A column that does not exist is an error.

    Strict casts follow the session (text that does not parse raises under ANSI); lenient ones give NULL.
    """
    return df.withColumns({name: _cast(df, name, t, strict) for name, t in types.items()}) if types else df


def override_present_types(df: DataFrame, types: Mapping[str, str], strict: bool = True) -> DataFrame:
    """Like `override_types`, but columns that do not exist are passed over."""
    return override_types(df, {n: t for n, t in types.items() if n in df.columns}, strict)


def with_source_file(scan: DataFrame, name: str) -> DataFrame:
    """Record in column `name` the file each row of a file scan comes from; no name, no column."""
    return scan.select("*", F.col("_metadata.file_path").alias(name)) if name else scan


def add_audit_columns(df: DataFrame, source: str) -> DataFrame:
    """Record when the rows were processed and where they came from."""
    return df.withColumns({"audit_timestamp": F.current_timestamp(), "audit_source": F.lit(source)})
