"""Sharding by sampled splitters: near equal bytes per shard, whatever the sizes and copies.

Every document gets a 64-bit key, the hash of its text in the high bits and of its id in the low ones, so
equal texts stand together and a huge group of them can still be cut. A size-weighted sample of the keys
gives quantile boundaries for `n_shards * RANGES_PER_SHARD` ranges. Rows and bytes of every range are
counted, overfull ranges subdivided, and running sums over the parts turn the order inside a part into the
exact byte offset of each document, from which its shard follows: shards differ by about one document.

One shuffle moves the rows, by part. The driver sees the sampled keys (about `ranges * SAMPLES_PER_RANGE`)
and one count per range, never the rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratiform.llm.common import field, table
from stratiform.workspace import stage

N_SHARDS = 40
RANGES_PER_SHARD = 8
SAMPLES_PER_RANGE = 64
MAX_ROWS = 500_000
MAX_BYTES = 1 << 30
OVERHEAD = 16
TEXT_BITS = 40
#: What the operator adds; input columns of these names are replaced.
DERIVED = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]


def keyed(docs: DataFrame, text: str, doc_id: str, keep: list[str]) -> DataFrame:
    body = F.coalesce(field(docs, text).cast("string"), F.lit(""))
    mask = (1 << (64 - TEXT_BITS)) - 1
    key = F.xxhash64(body).bitwiseAND(F.lit(~mask)).bitwiseOR(F.xxhash64(field(docs, doc_id), F.lit("id")).bitwiseAND(F.lit(mask)))
    return docs.select(
        F.struct(*(field(docs, c) for c in keep)).alias("row"),
        field(docs, doc_id).alias("id"),
        (F.octet_length(body) + OVERHEAD).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        key.alias("key"),
    )


def splitters(rows: DataFrame, total: int, ranges: int) -> np.ndarray:
    """Quantile boundaries of the keys by size, from a size-weighted sample of about `ranges * SAMPLES_PER_RANGE`."""
    draws = ranges * SAMPLES_PER_RANGE
    share = F.col("size") * F.lit(draws / total)
    chance = (F.xxhash64("key", "id", F.lit("sample")).bitwiseAND(F.lit((1 << 40) - 1)) / F.lit(float(1 << 40))).cast("double")
    picked = rows.where(chance < share).select("key", F.greatest(F.lit(1.0), share).alias("weight")).toPandas()
    picked = picked.sort_values("key")
    weight = picked["weight"].to_numpy().cumsum()
    if not len(weight):
        return np.array([], np.int64)
    at = np.searchsorted(weight, weight[-1] * np.arange(1, ranges) / ranges)
    return np.unique(picked["key"].to_numpy(np.int64)[np.minimum(at, len(weight) - 1)])


def range_of(bounds: np.ndarray) -> Column:
    @F.pandas_udf("int")
    def find(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, keys.to_numpy(np.int64), "right").astype(np.int32))

    return find("key")


def shard_documents(
    docs: DataFrame,
    n_shards: int = N_SHARDS,
    text: str = "text",
    doc_id: str = "doc_id",
    keep: list[str] | None = None,
    max_rows: int = MAX_ROWS,
    max_bytes: int = MAX_BYTES,
) -> DataFrame:
    """The columns `keep` (default: all) with size, text_crc32, law "bytes", shard, slot and grown_shard.

    The size of a document is the UTF-8 length of its text plus 16; a null text counts as empty. Slots count
    from 0 within each shard, in key order. Equal texts stand together but are cut where a shard is full;
    repeated rows are interchangeable and each gets a slot. A range of more than `max_rows` rows or `max_bytes`
    is sorted in parts; only rows equal in id and text stay in one. An empty table gives an empty result. `docs`
    should be a scan: it is read several times. Derived columns replace input columns of the same name.
    """
    keep = docs.columns if keep is None else keep
    rows = keyed(docs, text, doc_id, keep)
    if text not in keep:
        rows = stage(rows, "shard_keys")
    total = rows.agg(F.sum("size")).first()[0] or 0
    bounds = splitters(rows, total, n_shards * RANGES_PER_SHARD) if total else np.array([], np.int64)
    ranged = rows.withColumn("range", range_of(bounds))

    # One row per range.
    held = ranged.groupBy("range").agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).collect()
    loads = {r["range"]: max(r["n"] / max_rows, r["bytes"] / max_bytes) for r in held}
    cuts = [max(1, math.ceil(loads.get(i, 0))) for i in range(len(bounds) + 1)]
    # Only an overfull range is subdivided, by what the row holds: wherever it is read, it comes to the same part.
    spread = F.pmod(F.xxhash64("key", "id", "text_crc32", "size"), F.get(F.lit(cuts), F.col("range")))
    parted = ranged.withColumn("part", spread if max(cuts) > 1 else F.lit(0).cast("long"))

    before = Window.orderBy("range", "part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        parted.groupBy("range", "part")
        .agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"))
        .select(
            "range",
            "part",
            F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
            F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        )
    )
    inside = Window.partitionBy("range", "part").orderBy("key", "id", "text_crc32", "size")
    numbered = (
        parted.withColumn("nth", F.row_number().over(inside) - 1)
        .withColumn("until", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .join(stage(parts, "shard_parts"), ["range", "part"])
        .withColumn("place", F.col("rows_before") + F.col("nth"))
        # The middle of the document decides, so that no shard depends on which end a cut hits.
        .withColumn("twice", 2 * (F.col("bytes_before") + F.col("until")) - F.col("size"))
        .withColumn("shard", F.least(F.lit(n_shards - 1), F.floor(F.expr(f"twice * {n_shards} div {max(1, 2 * total)}"))).cast("int"))
    )
    first = numbered.groupBy("shard").agg(F.min("place").alias("first"))
    placed = numbered.join(F.broadcast(first), "shard")  # one row per shard
    kept = [c for c in keep if c not in DERIVED]
    return placed.select(
        *(F.col("row").getField(c).alias(c) for c in kept),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("place") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder of Parquet files per shard, rows in slot order inside each file."""
    sharded.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op3_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near equal bytes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return shard_documents(docs, keep=["doc_id"])


def stage_shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with shard and slot."""
    return shard_documents(docs)
