"""Ranked search against scoring every document."""

import math
import random
import re
from collections import Counter

import pytest

from stratiform.llm import ranking
from stratiform.llm.ranking import rank_documents

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return WORD.findall((text or "").translate(LOWER))


def expected(docs, items, best=20):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    big_n, big_l = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, Counter()).update(terms(t))
    out = []
    for item, query in asked.items():
        weight = {t: n * math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) for t, n in query.items()}
        scored = []
        for i, c in counted:
            m = 75 + (25 * c.total() * big_n) // big_l
            s = sum(w * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m)) for t, w in weight.items() if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        for rank, (s, _, _, i) in enumerate(sorted(scored, key=lambda r: r[:3])[:best], 1):
            out.append((item, rank, i, -s))
    return sorted(out, key=repr)


def frame(spark, rows, name):
    return spark.createDataFrame(rows, f"{name} long, text string")


def corpus(seed, n=400):
    rng = random.Random(seed)
    words = ["Wort%d" % i for i in range(150)] + ["é", "ñandú", "x1", "2024", "the", "THE"]
    weights = [1 / (i + 1) for i in range(len(words))]
    texts = [" ,".join(rng.choices(words, weights, k=rng.choice([0, 1, 5, 30, 300]))) for _ in range(n)]
    docs = list(enumerate(texts)) + [(n + i, texts[7]) for i in range(60)] + [(n + 100, None), (n + 101, ""), (n + 102, "!?")]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([1, 4, 12])))) for i in range(12)]
    return docs, [*items, (50, None), (51, "unknownterm"), (52, docs[7][1]), (53, "wort1 " * 40)]


@pytest.mark.parametrize("small", [False, True])
def test_ranks_equal_scoring_everything(spark, rows, monkeypatch, small):
    if small:
        monkeypatch.setattr(ranking, "BUCKET", 16)
        monkeypatch.setattr(ranking, "CHUNK_ENTRIES", 500)
    docs, items = corpus(3)
    found = rank_documents(
        frame(spark, docs, "doc_id").repartition(5), frame(spark, items, "item_id"), sample=50 if small else 1 << 13, block_bytes=600 if small else 1 << 20
    )
    assert rows(found, "item_id", "rank", "doc_id", "score") == expected(docs, items)
    assert dict(found.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}


def test_ties_stand_by_id_and_null_ids_last(spark, rows):
    docs = [(i, "same words here") for i in range(30, 0, -1)] + [(None, "same words here"), (99, "other")]
    items = [(1, "same words"), (1, "same"), (None, "other")]
    got = rank_documents(frame(spark, docs, "doc_id").repartition(4), frame(spark, items, "item_id"))
    assert rows(got, "item_id", "rank", "doc_id", "score") == expected(docs, items)
    few = rank_documents(frame(spark, docs[-3:], "doc_id"), frame(spark, items, "item_id"))
    assert rows(few, "item_id", "rank", "doc_id", "score") == expected(docs[-3:], items)


def test_very_long_and_repeated_documents(spark, rows):
    docs = [(1, "a b " * 50_000 + "c"), (2, "c"), (2, "c"), (3, "word " * 10)]
    items = [(1, "c c a"), (2, "word")]
    got = rank_documents(frame(spark, docs, "doc_id"), frame(spark, items, "item_id"))
    assert rows(got, "item_id", "rank", "doc_id", "score") == expected(docs, items)


def test_empty_tables_and_clashing_columns(spark):
    none, one = frame(spark, [], "doc_id"), frame(spark, [(1, "a b")], "doc_id")
    items = frame(spark, [(1, "a")], "item_id")
    assert rank_documents(none, items).count() == 0 and rank_documents(one, frame(spark, [], "item_id")).count() == 0
    odd = spark.createDataFrame([("k", "a b", 5, 6)], "doc_id string, `my.text` string, score int, rank int")
    asked = spark.createDataFrame([("q", "A")], "doc_id string, text string")
    got = rank_documents(odd, asked, text="my.text", item_id="doc_id").collect()
    assert [(r["item_id"], r["rank"], r["doc_id"]) for r in got] == [("q", 1, "k")] or got == []
