"""The registered queries of this folder and their SQL."""

from __future__ import annotations

from stratiform.llm import alignment, chat, decontaminate, licenses, mixing, neardup, pii, quality, ranking, rules, secrets, sharding, vectors

MODULES = (alignment, chat, decontaminate, licenses, mixing, neardup, pii, quality, ranking, rules, secrets, sharding, vectors)

QUERIES = {name: value for module in MODULES for name, value in vars(module).items() if name.startswith("op") and "_" in name and callable(value)}
ORACLE_SQL = {name: sql for module in MODULES for name, sql in getattr(module, "ORACLE_SQL", {}).items()}
