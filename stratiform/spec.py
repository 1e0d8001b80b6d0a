"""Entity specification: how one bronze source becomes one silver table."""

from __future__ import annotations

import json
import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

log = logging.getLogger(__name__)

# The folder levels every bronze load is written under.
LOAD_COLUMNS = ("segment", "year", "month", "day", "load")

# Types of the load columns wherever single loads are read; a folder's digits alone may suggest others.
LOAD_TYPES = dict(zip(LOAD_COLUMNS, ("string", "int", "int", "int", "bigint"), strict=True))

# The newest load wins; `segment` names the kind of load and carries no recency.
RECENCY_COLUMNS = LOAD_COLUMNS[1:]


@dataclass(frozen=True)
class EntitySpec:
    """Configuration of one entity. Only the driver reads it."""

    format: str
    source: str
    load_type: str
    destination: str
    surrogate_key: str | None = None
    business_key: Sequence[str] = ()
    projected_columns: Sequence[str] = ()
    override_column_types: Mapping[str, str] = field(default_factory=dict)
    options: Mapping[str, str] = field(default_factory=dict)
    custom_transform: str = "default"
    strict_casts: bool = True
    #: A merged table keeps its rows in so many partitions by key, and a merge rewrites those it touches; 0: one table.
    key_buckets: int = 0
    #: Column that names the file each row was read from; none if empty.
    source_file_column: str = ""

    def __post_init__(self) -> None:
        if self.custom_transform == "default" and not self.surrogate_key:
            raise ValueError(f"{self.destination}: the default transform needs a surrogate_key")
        if self.load_type == "merge" and not self.business_key:
            raise ValueError(f"{self.destination}: load_type 'merge' needs a business_key")

    def kept_columns(self) -> list[str]:
        """The projected columns, with that of the source file; none stands for all."""
        named = [self.source_file_column] if self.source_file_column else []
        return [*self.projected_columns, *(c for c in named if c not in self.projected_columns)] if self.projected_columns else []

    @classmethod
    def from_dict(cls, raw: Mapping) -> EntitySpec:
        missing = [k for k in ("format", "source", "load_type", "destination") if k not in raw]
        if missing:
            raise ValueError(f"entity specification lacks {', '.join(missing)}")
        other = sorted(set(raw) - set(cls.__dataclass_fields__))
        if other:
            log.warning("entity %s: keys without meaning here: %s", raw["destination"], ", ".join(other))
        return cls(**{k: v for k, v in raw.items() if v is not None and k not in other})

    @classmethod
    def from_json(cls, text: str) -> list[EntitySpec]:
        """Read one specification or a list of them."""
        raw = json.loads(text)
        return [cls.from_dict(item) for item in (raw if isinstance(raw, list) else [raw])]

    @classmethod
    def from_file(cls, spark: SparkSession, path: str) -> list[EntitySpec]:
        """Read the metadata file of a lakehouse, wherever Spark can read it."""
        return cls.from_json(spark.read.text(path, wholetext=True).first()["value"])
