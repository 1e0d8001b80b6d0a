"""Client registry kept in a relational database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Table and columns of the registry.
REGISTRY_TABLE = "dbo.Client"
CLIENT_COLUMN, UNIQUE_ID_COLUMN = "ClientGUID", "RandomUniqueId"


def read_registry(spark: SparkSession, url: str, table: str = REGISTRY_TABLE, **options: str) -> DataFrame:
    """The registry over JDBC; only the two columns are fetched. Pass driver, user, partitioning as options."""
    registry = spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
    return one_id_per_client(registry)


def one_id_per_client(registry: DataFrame) -> DataFrame:
    """One unique id per client. A client listed several times gets the largest, so re-runs agree."""
    return registry.groupBy(CLIENT_COLUMN).agg(F.max(UNIQUE_ID_COLUMN).alias(UNIQUE_ID_COLUMN))
