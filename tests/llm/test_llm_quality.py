import zlib

import numpy as np
import pytest

from stratiform.llm import quality

SF = "/root/testdata/sf0.1"


def test_pair_fit_orders_by_strength():
    random = np.random.default_rng(4)
    x = random.normal(size=(800, 5))
    truth = np.array([2.0, -1.0, 0.5, 0.0, 0.0])
    good = x @ truth + random.normal(size=800) * 0.3 > -1.0
    ranking = quality.fit(x, good)
    assert ((ranking.score(x) >= quality.CUT) == good).mean() > 0.9
    assert (~(ranking.score(x) >= quality.CUT)).sum() == pytest.approx((~good).sum(), abs=1)


def test_pair_fit_is_the_minimum():
    random = np.random.default_rng(6)
    better, worse = random.normal(size=(200, 3)) + 0.5, random.normal(size=(200, 3))
    w = quality.fit_pairs(better, worse)
    loss = lambda v: np.logaddexp(0, -((better - worse) @ v)).mean() + quality.RIDGE * (v @ v)
    assert all(loss(w) <= loss(w + 0.01 * random.normal(size=3)) for _ in range(50))


def test_one_label_only_scores_all_alike():
    ranking = quality.fit(np.ones((3, 2)), np.array([True] * 3))
    assert len(set(ranking.score(np.random.default_rng(1).normal(size=(5, 2))).tolist())) == 1


def test_held_out_accuracy(spark):
    from stratiform.llm.common import table

    scored = quality.op2_bradley_terry(spark, SF)
    labels = table(spark, SF, "labels").select("doc_id", "quality")
    rows = scored.join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 500
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in rows)
    bad = [r for r in rows if r["quality"] == 0]
    good = [r for r in rows if r["quality"] == 1]
    assert sum(r["predicted"] == 0 for r in bad) / len(bad) > 0.97
    assert sum(r["predicted"] == 1 for r in good) / len(good) > 0.99
    assert all((r["score"] >= 0.7) == (r["predicted"] == 1) and 0 <= r["score"] <= 1 for r in rows)


def test_edge_rows(spark):
    docs = [(i, "fine words in a plain sentence. " * (i % 7 + 3)) for i in range(40)] + [(100 + i, "BAD!! *** || " * (i % 5 + 3)) for i in range(40)]
    edge = [(500, None), (501, ""), (501, ""), (None, "x"), (502, "y" * 500_000)]
    frame = spark.createDataFrame([(d, t, "clash") for d, t in docs + edge], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(d, int(d < 100)) for d, _ in docs] + [(None, 1), (3, None), (9999, 0)], "doc_id long, quality int")
    ranking = quality.train(frame, labels)
    rows = quality.score_documents(frame, ranking).collect()
    assert len(rows) == len(docs) + len(edge)
    assert all(r["predicted"] == int(r["doc_id"] < 100) for r in rows if r["doc_id"] is not None and r["doc_id"] < 200)
    assert len({r["score"] for r in rows if r["doc_id"] in (500, 501)}) == 1
    nothing = quality.train(frame.limit(0), labels)
    assert quality.score_documents(frame.limit(0), nothing).count() == 0
