"""The pipeline against brute force on a small table, and that the rest of the library does without this folder."""

import os
import subprocess
import sys
from collections import Counter, defaultdict

import duckdb
import pytest

import corpus_pipeline
import test_llm_decontaminate as decontaminate
import test_llm_mixing as mixing
import test_llm_neardup as neardup
from stratiform.llm import quality
from stratiform.llm.common import table
from stratiform.llm.queries import ORACLE_SQL, QUERIES
from stratiform.workspace import stage

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))


def test_every_stage_does_what_brute_force_does(spark):
    docs = table(spark, SF, "documents")
    columns, results = docs.columns, []
    for _, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, SF))
        results.append([r.asDict() for r in docs.collect()])
    accepted, single, clean, mixed, sharded = results
    assert all(list(r) == columns for rows in results[:4] for r in rows)

    scored = {r["doc_id"]: r["predicted"] for r in quality.op2_bradley_terry(spark, SF).collect()}
    assert sorted(r["doc_id"] for r in accepted) == sorted(d for d, p in scored.items() if p == 1)

    groups = neardup.brute([(r["doc_id"], r["text"]) for r in accepted])
    assert sorted(r["doc_id"] for r in single) == sorted(d for d, _, component in groups if d == component)

    items = [(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()]
    keep = []
    for r in single:
        n_words, n_hit, _ = decontaminate.brute(r["text"], items, 13)
        if not (n_hit and 20 * n_hit >= n_words):
            keep.append(r["doc_id"])
    assert sorted(r["doc_id"] for r in clean) == sorted(keep) and len(keep) < len(single)

    sizes, of, texts = Counter(), {}, {}
    for r in clean:
        sizes[r["source"]] += mixing.words(r["text"])
        of[r["doc_id"]], texts[r["doc_id"]] = r["source"], r["text"]
    target, taken = mixing.target_by_rounds(sizes), Counter()
    for r in mixed:
        assert texts[r["doc_id"]].startswith(r["text"])
        taken[of[r["doc_id"]]] += mixing.words(r["text"])
    assert all(abs(taken[s] - target[s]) <= max(1, sizes[s] // 1024 + 1) for s in sizes)
    assert max(Counter(r["doc_id"] for r in mixed).values()) <= 3

    assert Counter((r["doc_id"], r["text"]) for r in sharded) == Counter((r["doc_id"], r["text"]) for r in mixed)
    slots, load = defaultdict(list), Counter()
    for r in sharded:
        slots[r["shard"]].append(r["slot"])
        load[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(load.values()) - sum(load.values()) / 40 <= max(r["size"] for r in sharded)


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    db = duckdb.connect()
    for own in ("documents", "benchmark", "embeddings"):
        db.execute(f"CREATE VIEW {own} AS SELECT * FROM read_parquet('{SF}/{own}.parquet')")
    found, relation = QUERIES[name](spark, SF), db.sql(ORACLE_SQL[name])
    assert sorted(found.columns) == sorted(relation.columns)
    names = ", ".join(sorted(relation.columns))
    assert sorted(map(repr, map(tuple, found.select(*sorted(found.columns)).collect()))) == sorted(map(repr, db.sql(f"SELECT {names} FROM relation").fetchall()))


def test_run_applies_all_stages(spark):
    assert corpus_pipeline.run(spark, SF).columns[-1] == "grown_shard"


def test_the_rest_imports_without_this_folder():
    code = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] == "corpus_pipeline" or name.startswith("stratiform.llm"):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as entry
names = set(entry.queries())
assert "whole_run" in names and "pipeline" not in names and not any(n.startswith("op") for n in names), names
assert set(entry.oracle_sql()) <= names
"""
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def test_one_query_of_each_operator_is_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13 and "pipeline" in names
