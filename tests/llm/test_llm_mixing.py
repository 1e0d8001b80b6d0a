import re
from collections import Counter, defaultdict
from math import comb

import pytest
from pyspark.sql import functions as F

from stratiform.llm import mixing

SCHEMA = "doc_id long, text string, source string, size string"


def target_by_rounds(sizes):
    """Shares by weight; what is above three times a size is shared again until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        open_ = [s for s in names if s not in full]
        rest = total - sum(3 * sizes[s] for s in full)
        target = {s: 3 * sizes[s] if s in full else rest * weight[s] / sum(weight[o] for o in open_) for s in names}
        over = {s for s in open_ if target[s] > 3 * sizes[s]}
        if not over:
            return target
        full |= over


def documents():
    rows = [(i, "w " * (1 + i * 7 % 40), f"s{i % 5}") for i in range(600)]
    rows += [(1000 + i, "x y\tz\n" * 3, "Ä") for i in range(8)] + [(2000 + i, "big " * 900, "z") for i in range(30)]
    rows += [(3000, "again and again", "s1")] * 200  # identical rows
    rows += [(4000, None, "s1"), (4001, "", "s2"), (4002, "no source here", None), (4003, "empty source", ""), (None, "no id", "s3"), (4004, " \n ", "only blank")]
    return [(d, t, s, "clash") for d, t, s in rows]


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_targets_and_taken_words(spark):
    docs = documents()
    frame = spark.createDataFrame(docs, SCHEMA).repartition(4)
    rows = mixing.mix_sources(frame, keep=["doc_id", "source"]).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(d[0] for d in docs)
    sizes = Counter()
    for _, text, source, _ in docs:
        sizes[source] += words(text)
    want = target_by_rounds(sizes)
    taken = Counter()
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        assert r["taken"] == sum(m["words"] for m in r["mix"])
        taken[r["source"]] += r["taken"]
    for source, goal in want.items():
        block = max(1, sizes[source] // mixing.LEAST_BLOCKS + 1)
        assert abs(taken[source] - goal) <= block


def test_reruns_agree_however_the_table_is_split(spark):
    frame = spark.createDataFrame(documents(), SCHEMA)
    runs = [sorted(map(repr, mixing.mix_sources(frame.repartition(n), keep=["doc_id"]).select("doc_id", "size", "target", "taken").collect())) for n in (2, 7)]
    assert runs[0] == runs[1]


def test_identical_rows_lose_no_words(spark, monkeypatch):
    """A source of copies of one short row takes its target to the word, and all but one copy of a pass are whole."""
    monkeypatch.setattr(mixing, "COPIES_PER_TASK", 100)
    docs = [(1, "one", "a", "x")] * 999 + [(2, "two words", "b", "x")] * 50 + [(i, "w " * 30, "c", "x") for i in range(100, 140)]
    rows = mixing.mix_sources(spark.createDataFrame(docs, SCHEMA).repartition(5), keep=["doc_id", "source"]).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(d[0] for d in docs)
    taken, target = Counter(), {}
    for r in rows:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert r["taken"] <= 3 * r["size"]
    for source, goal in target.items():
        assert abs(taken[source] - goal) <= 2, source
    for source in "ab":
        own = [r for r in rows if r["source"] == source]
        assert sum(any(m["words"] < r["size"] for m in r["mix"]) for r in own) <= 1
        assert len({m["place"] for r in own for m in r["mix"]}) == sum(len(r["mix"]) for r in own)


def test_many_sources(spark):
    draws = spark.range(20_000).selectExpr("cast(id AS int) AS idx", "id % 7 AS draws")
    upto = mixing.shard_quotas(draws, 3, 1)
    held = upto.join(draws, "idx").selectExpr("sum(cast(element_at(upto, -1) = draws AS int)) AS good", "count(*) AS n", "sum(upto[0]) AS first", "sum(upto[1]) AS second", "sum(draws) AS total").first()
    assert held["good"] == held["n"] == 20_000 and upto.where("exists(upto, x -> x < 0) OR upto[0] > upto[1]").isEmpty()
    assert abs(held["first"] - held["total"] / 3) <= 2 and abs(held["second"] - 2 * held["total"] / 3) <= 2


def test_shards_get_their_quotas(spark):
    frame = spark.createDataFrame(documents(), SCHEMA)
    mixed = mixing.mix_sources(frame, n_shards=7)
    copies = mixing.mixed_copies(mixed).collect()
    assert {r["shard"] for r in copies} == set(range(7))
    own = Counter()
    for r in copies:
        assert words(r["text"]) == r["words"]
        own[r["shard"]] += r["words"]
    assert sum(own.values()) == mixed.agg(F.sum("taken")).first()[0]


def test_tree_keeps_every_block(spark):
    draws = [5, 0, 1000, 37, 1, 12_345]
    sources = spark.createDataFrame([(i, n) for i, n in enumerate(draws)], "idx int, draws long")
    upto = {r["idx"]: r["upto"] for r in mixing.shard_quotas(sources, 13, 1).collect()}
    quotas = {i: [b - a for a, b in zip([0, *u], u)] for i, u in upto.items()}
    assert [sum(quotas[i]) for i in range(len(draws))] == draws
    assert all(q >= 0 for own in quotas.values() for q in own)
    per_shard = [sum(quotas[i][k] for i in quotas) for k in range(13)]
    assert max(per_shard) - min(per_shard) <= 4


@pytest.mark.parametrize("marked,drawn,total", [(7, 12, 30), (1, 1, 2), (0, 5, 9), (9, 9, 9), (3, 0, 5)])
def test_hypergeometric_law(spark, marked, drawn, total):
    number = lambda n: F.lit(n).cast("long")
    k = mixing.hypergeometric(number(marked), number(drawn), number(total), mixing.uniform(F.lit(3), F.col("id")))
    counts = {r["k"]: r["n"] for r in spark.range(8000).select(k.alias("k")).groupBy("k").agg(F.count("*").alias("n")).collect()}
    for value in range(max(0, drawn + marked - total), min(drawn, marked) + 1):
        law = comb(marked, value) * comb(total - marked, drawn - value) / comb(total, drawn)
        assert counts.pop(value, 0) / 8000 == pytest.approx(law, abs=0.03)
    assert not counts


def test_empty_table(spark):
    assert mixing.mix_sources(spark.createDataFrame([], SCHEMA)).count() == 0
