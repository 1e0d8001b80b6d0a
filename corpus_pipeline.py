"""Corpus pipeline: stages applied to `documents`, each written as Parquet and reread by the next.

1. quality classifier          documents that it rejects go
2. n-gram Jaccard join         one document of each group of near duplicates stays
3. benchmark decontamination   contaminated documents go
4. mixing to target weights    copies that the mix takes; one per source and pass may be cut
5. sharding                    shard and slot of every row
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratiform.llm.common import table
from stratiform.llm.decontaminate import stage_decontaminate
from stratiform.llm.mixing import stage_mix
from stratiform.llm.neardup import stage_near_duplicates
from stratiform.llm.quality import stage_quality
from stratiform.llm.sharding import stage_shard
from stratiform.workspace import stage

STAGES = [
    ("quality classifier", stage_quality),
    ("n-gram Jaccard join", stage_near_duplicates),
    ("benchmark decontamination", stage_decontaminate),
    ("mixing sources to target weights", stage_mix),
    ("sharding", stage_shard),
]

#: No stage as a whole can be expressed in SQL; tests/llm compares run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
