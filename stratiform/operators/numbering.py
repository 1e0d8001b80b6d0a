"""Dense row numbers without sending all rows through one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratiform.workspace import as_written, fresh_name, is_written, stage

# monotonically_increasing_id() puts the partition in the upper bits and the position in the lower 33.
_POSITION_BITS = 33


def number_rows(
    df: DataFrame, name: str, after: int = 0, order_by: Sequence[str] = (), ranged: bool = False
) -> DataFrame:
    """Add `name`: bigint numbers after+1, after+2, ... without gaps.

    With `order_by` the numbers follow that order, as ROW_NUMBER() OVER (ORDER BY ...) would; list
    enough columns to make the order total. Without it the order is arbitrary but fixed once written.
    `ranged` says that the partitions of `df` are ranges in that order already.

    Rows are written once, together with the partition and position they were written at. Only the row
    count per partition is then needed to turn positions into numbers: one small row per task, which
    bounds the running sum and the broadcast by the number of tasks, not of rows.
    """
    columns = df.columns
    slot, before = fresh_name(columns, "_slot"), fresh_name(columns, "_before")
    first = fresh_name(columns, "_part")
    if order_by:
        # Range partitioning samples its input and then reads it again, both from the last shuffle where there is one.
        # What may differ from one evaluation to the next is written before, so that the sample is one of the rows that follow.
        if not ranged and not is_written(df) and not df._jdf.queryExecution().analyzed().deterministic():
            df = stage(df, "unordered")
        df = (df if ranged else df.repartitionByRange(*order_by)).sortWithinPartitions(*order_by)
    written = stage(df.withColumn(slot, F.monotonically_increasing_id()), "numbered")
    part = F.shiftright(slot, _POSITION_BITS)
    position = F.col(slot).bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))

    earlier = Window.orderBy(first).rowsBetween(Window.unboundedPreceding, -1)
    offsets = stage(
        written.groupBy(part.alias(first))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(first, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias(before)),
        "offsets",
    )
    number = F.lit(after).cast("bigint") + F.col(before) + position + 1
    numbered = written.join(F.broadcast(offsets), part == F.col(first))
    return as_written(numbered.select(*[f"`{c}`" for c in columns], number.alias(name)))


def max_key(df: DataFrame, name: str) -> int:
    """Largest key in use, 0 for an empty table. One value reaches the driver."""
    return df.agg(F.coalesce(F.max(name), F.lit(0)).cast("bigint")).first()[0]
