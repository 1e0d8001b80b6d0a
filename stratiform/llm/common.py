"""Helpers shared by the operators of this folder: tables, staged results, text batches in tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.workspace import new_path, staging_scope

#: Text handled at once inside a task; a single longer text is a slice of its own.
SLICE_BYTES = 4 << 20

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Byte tables: A-Z to a-z, and everything that is no word byte (a-z, 0-9, 0x80-0xFF) to a space.
ALNUM_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written_result(spark: SparkSession, purpose: str, build: Callable[[], DataFrame]) -> DataFrame:
    """What `build` makes, written to the shared folder; all that was staged on the way is removed."""
    path = new_path(spark, purpose)
    with staging_scope(spark):
        made = build()
        made.write.parquet(path)
        schema = made.schema
    return spark.read.schema(schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    """Only A-Z are folded; `lower` would fold every alphabet."""
    return F.translate(text, UPPER, UPPER.lower())


def field(df: DataFrame, name: str) -> Column:
    """A column by its exact name, dots included."""
    return df["`" + name.replace("`", "``") + "`"]


def settled(df: DataFrame, name: str, value: Column) -> DataFrame:
    """`df` with a column that is computed once per row.

    Spark moves the expression of a plain column into whatever uses it, also into a lambda, where it would be
    computed anew for every element. It does not move what a generator makes, here one row from each row.
    """
    return df.select(*(c for c in df.columns if c != name), F.explode(F.array(value)).alias(name))


def set_aside(df: DataFrame, keep: list[str]) -> list[Column]:
    """The kept columns under names that no derived column has."""
    return [field(df, c).alias(f"_kept{i}") for i, c in enumerate(keep)]


def set_back(keep: list[str], derived: list[str]) -> list[Column]:
    """The kept columns under their own names, without those that a derived column replaces."""
    return [F.col(f"_kept{i}").alias(c) for i, c in enumerate(keep) if c not in derived]


def with_derived(df: DataFrame, row: str, derived: list[str]) -> DataFrame:
    """Unpack the struct `row`; a derived column replaces an input column of the same name."""
    kept = [c for c in df.schema[row].dataType.names if c not in derived]
    return df.select(*(F.col(row).getField(c).alias(c) for c in kept), *derived)


def text_slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of each piece stay below `limit` bytes, one text at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        cuts = [0]
        total = 0
        for i, size in enumerate(sizes.tolist()):
            if total + size > limit and i > cuts[-1]:
                cuts.append(i)
                total = 0
            total += size
        for start, stop in pairwise([*cuts, batch.num_rows]):
            yield batch.slice(start, stop - start)


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of every text; null is empty."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def map_texts(
    docs: DataFrame,
    text: str,
    derived: T.StructType,
    function: Callable[[pa.Array], dict[str, object]],
    limit: int = SLICE_BYTES,
) -> DataFrame:
    """Derive columns from a text column, slice by slice, without a shuffle.

    `function` gets the texts of a slice and returns the derived columns. Input columns pass through
    unread; one that has the name of a derived column is replaced.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    names = derived.names
    types = {f.name: f.type for f in to_arrow_schema(derived)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in text_slices(batches, "text", limit):
            made = function(piece.column("text"))
            arrays = [made[n] if isinstance(made[n], pa.Array) else pa.array(made[n], types[n]) for n in names]
            yield pa.RecordBatch.from_arrays([piece.column("row"), *arrays], ["row", *names])

    packed = docs.select(F.struct(*(field(docs, c) for c in docs.columns)).alias("row"), field(docs, text).cast("string").alias("text"))
    out = T.StructType([packed.schema["row"], *derived.fields])
    return with_derived(packed.mapInArrow(run, out), "row", names)
