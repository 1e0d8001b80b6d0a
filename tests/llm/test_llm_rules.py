import random
import re
from collections import Counter

from pyspark.sql import functions as F

from stratiform.llm import rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = Counter(windows)
    covered = {j for i, g in enumerate(windows) if often[g] > 1 for j in (i, i + 1, i + 2)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_measures_match_brute_force(spark):
    source = random.Random(4)
    texts = [None, "", " ", "\n\n", "a", "a b", "a b c", "a b c a b c", "a a a a", "a a a", "x\ty\x0bz\x0cu\rv", "é ü ß   x", "l\nl\n \n\nl\n", "q " * 30_000]
    texts += [" ".join(source.choice("abc|#\n") for _ in range(source.randint(0, 40))) for _ in range(300)]
    frame = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, kept string")
    weights = rules.ratio_weights(rules.multinomial(frame, 50), rules.multinomial(frame.limit(0), 50), 50)
    rows = rules.apply_rules(frame, weights, buckets=50).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute(texts[r["doc_id"]])
        assert tuple(r[m] for m in rules.MEASURES) == want, texts[r["doc_id"]]
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert r["kept"] == (not r["base_failed"] and r["score"] >= rules.THRESHOLD)


def test_weights_are_log_ratios(spark):
    import math

    raw, good = ["a b", "c & d", "c & d"], ["a b"]
    frame = lambda texts: spark.createDataFrame([(t,) for t in texts], "text string")
    slots = lambda texts: Counter(r[0] for r in rules.with_slots(frame(texts), "text", "s", 8).select(F.explode("s")).collect())
    weights = rules.ratio_weights(rules.multinomial(frame(raw), 8), rules.multinomial(frame(good), 8), 8).first()["weights"]
    r, g = slots(raw), slots(good)
    assert sum(r.values()) == 3 + 5 + 5
    for slot in range(8):
        want = math.log((g[slot] + 1) / (sum(g.values()) + 8) / ((r[slot] + 1) / (sum(r.values()) + 8)))
        assert abs(weights[slot] - want) < 1e-12


def test_labels_are_told_apart(spark):
    from stratiform.llm.common import table

    sf = "/root/testdata/sf0.01"
    judged = rules.op8_ngram_ratio_rules(spark, sf).join(table(spark, sf, "labels"), "doc_id").where("not base_failed").collect()
    assert all(r["kept"] == (r["quality"] == 1) for r in judged)


def test_empty_tables(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    weights = rules.ratio_weights(rules.multinomial(frame, 5), rules.multinomial(frame, 5), 5)
    assert weights.first()["weights"] == [0.0] * 5
    assert rules.apply_rules(frame, weights, buckets=5).count() == 0
    assert rules.trusted_documents(frame, spark.createDataFrame([(None, 1)], "doc_id long, quality int")).count() == 0


def test_every_trusted_document_counts(spark):
    """More good documents than any fixed number that was once taken, broadcast and shuffled alike."""
    n = 20_100
    docs = spark.range(n).select(F.when(F.col("id") < n - 2, F.col("id")).alias("doc_id"), F.concat_ws(" ", F.lit("w"), F.col("id") % 7).alias("text"))
    docs = docs.union(docs.where("doc_id = 5"))
    labels = spark.range(n).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    labels = labels.union(labels.limit(50)).union(spark.sql("select cast(null as long), 1")).union(spark.sql("select 0L, 0"))
    own = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for key in own:
        spark.conf.set(key, "-1")
    try:
        for limit in (rules.BROADCAST_BYTES, 0):
            counts = rules.corpus_and_trusted(docs, labels, 64, limit)
            rows = counts.collect()
            assert ("SortMergeJoin" in counts._jdf.queryExecution().executedPlan().toString()) == (limit == 0)
            trusted = {r["slot"]: r["n"] for r in rules.multinomial(rules.trusted_documents(docs, labels), 64).collect()}
            assert sum(r["raw"] for r in rows) == 3 * (n + 1) and sum(r["target"] for r in rows) == 3 * (n - 1)
            assert {r["slot"]: r["target"] for r in rows if r["target"]} == trusted
            assert {r["slot"]: r["raw"] for r in rows} == {r["slot"]: r["n"] for r in rules.multinomial(docs, 64).collect()}
    finally:
        for key in own:
            spark.conf.unset(key)
