"""Quality rules: hashed n-gram log-likelihood ratio of a trusted target against the raw corpus.

Tokens (what white space parts, ASCII punctuation apart) and pairs of them are hashed into `BUCKETS` slots.
Over all trusted documents (those labelled good) and over the whole corpus, two smoothed
multinomials are counted; the logarithm of their ratio is the weight of a slot, and the score of a document
is the mean weight of its n-grams. A fixed threshold decides for every document. Before it, plain counts
decide: few words, or many repeats.

Only DataFrame functions are used. Documents are reduced to their slots and both multinomials counted in one
pass. Good ids that fit `BROADCAST_BYTES` are broadcast, and counting adds up in each task, so at most
`BUCKETS` rows per task are shuffled; beyond that, ids and slots (two bytes each) are, never texts. The
weights, `BUCKETS` numbers, are a constant of the scoring plan. Everything about one document is computed
inside its row, linear in its length but for one sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.llm.common import field, set_aside, set_back, settled, table
from stratiform.operators.lookup import broadcast_if_small
from stratiform.workspace import stage

BUCKETS = 10_000
SMOOTHING = 1.0
THRESHOLD = -0.25
LEAST_WORDS = 50
MOST_REPEATS = 50  # per cent of the words

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
MARKS = r"[!-/:-@\[-^`{-~]+"
SYMBOLS = r"[#*$%&|<>]"
#: Good ids are broadcast up to this size, measured; more of them meet the slots of the documents in a shuffle.
BROADCAST_BYTES = 16 << 20
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
DERIVED = [*MEASURES, "base_failed", "score", "kept"]


def with_slots(df: DataFrame, text: str, out: str, buckets: int = BUCKETS) -> DataFrame:
    """`df` with the slot of every token of `text` and of every pair of neighbouring tokens."""
    apart = F.split(F.regexp_replace(text, MARKS, " $0 "), SPACE, -1)
    hashes = F.transform(F.array_remove(apart, ""), lambda t: F.xxhash64(t))
    df = settled(df, "_hashes", hashes)
    n = F.size("_hashes")
    pairs = F.zip_with(F.slice("_hashes", 1, F.greatest(n - 1, F.lit(0))), F.slice("_hashes", 2, n), lambda a, b: F.xxhash64(a, b))
    slot = F.transform(F.concat("_hashes", pairs), lambda h: F.pmod(h, F.lit(buckets)).cast("int"))
    return settled(df, out, slot).drop("_hashes")


def multinomial(texts: DataFrame, buckets: int) -> DataFrame:
    """slot and n over all n-grams of the column `text`."""
    return with_slots(texts.select("text"), "text", "slots", buckets).select(F.explode("slots").alias("slot")).groupBy("slot").agg(F.count("*").alias("n"))


def ratio_weights(corpus: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> DataFrame:
    """One row with `weights`, the logarithm of P(slot | trusted) / P(slot | corpus) for every slot in order."""
    both = (
        corpus.select("slot", F.col("n").alias("raw"), F.lit(0).cast("long").alias("target"))
        .union(trusted.select("slot", F.lit(0).cast("long").alias("raw"), F.col("n").alias("target")))
        .union(corpus.sparkSession.range(buckets).select(F.col("id").cast("int").alias("slot"), F.lit(0).cast("long"), F.lit(0).cast("long")))
        .groupBy("slot")
        .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    )
    rows = F.array_sort(F.collect_list(F.struct("slot", "raw", "target")))
    share = lambda n, total: (n + F.lit(smoothing)) / (total + F.lit(smoothing * buckets))
    return both.agg(rows.alias("rows"), F.sum("raw").alias("raw"), F.sum("target").alias("target")).select(
        F.transform("rows", lambda r: F.log(share(r["target"], F.col("target")) / share(r["raw"], F.col("raw")))).alias("weights")
    )


def with_repeated_words(df: DataFrame, words: str, out: str) -> DataFrame:
    """`df` with how many words lie in a 3-word window that occurs at least twice.

    Window hashes are sorted together with their places, packed into one long: as many low bits as places
    need, the hash above. Neighbours with equal high bits are compared by their full hashes.
    """
    df = settled(df, "_words", F.transform(words, lambda w: F.xxhash64(w)))
    windows = F.transform("_words", lambda w, i: F.xxhash64(w, F.get("_words", i + 1), F.get("_words", i + 2)))
    df = settled(df, "_hashes", F.slice(windows, 1, F.greatest(F.size(words) - 2, F.lit(0))))
    some = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    df = settled(df, "_bits", F.when(some, F.ceil(F.log2(F.size("_hashes") + 1.0)).cast("int")))
    df = settled(df, "_low", F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_bits")) - 1)
    pack = F.transform("_hashes", lambda h, i: F.call_function("shiftleft", h, F.col("_bits")).bitwiseOR(i.cast("long")))
    df = settled(df, "_packed", F.when(F.col("_bits").isNotNull(), F.sort_array(pack)))
    full = lambda p: F.get("_hashes", p.bitwiseAND(F.col("_low")).cast("int"))
    alike = lambda p, q: q.isNotNull() & (full(p) == full(q))
    same = F.filter("_packed", lambda p, i: alike(p, F.get("_packed", i - 1)) | alike(p, F.get("_packed", i + 1)))
    places = F.sort_array(F.transform(same, lambda p: p.bitwiseAND(F.col("_low")).cast("int")))
    covered = F.aggregate(
        places,
        F.struct(F.lit(-3).alias("last"), F.lit(0).alias("sum")),
        lambda s, p: F.struct(p.alias("last"), (s["sum"] + F.least(F.lit(3), p - s["last"])).alias("sum")),
        lambda s: s["sum"],
    )
    return settled(df, out, F.coalesce(covered, F.lit(0)).cast("long")).drop("_words", "_hashes", "_bits", "_low", "_packed")


def measures(text: Column, words: Column) -> dict[str, Column]:
    """The plain counts of a text and its words."""
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD))
    return {
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
    }


def apply_rules(
    docs: DataFrame,
    weights: DataFrame,
    text: str = "text",
    threshold: float = THRESHOLD,
    keep: list[str] | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """The columns `keep` (default: all) with the measures, base_failed, score and kept.

    Null and empty texts have no words, score 0 and fail the base rules. `kept` is false if the base rules
    fail, else whether the score reaches the threshold. Repeated rows are judged alike. Derived columns
    replace input columns of the same name.
    """
    keep = docs.columns if keep is None else keep
    body = F.coalesce(field(docs, text).cast("string"), F.lit(""))
    packed = docs.select(*set_aside(docs, keep), body.alias("body"))
    packed = settled(packed, "words", F.array_remove(F.split("body", SPACE, -1), ""))
    # A constant of the plan: `buckets` numbers, folded once from text.
    known = weights.first()["weights"]
    own = F.split(F.lit(" ".join(map(repr, known))), " ").cast("array<double>")
    counted = with_repeated_words(packed, "words", "n_repeat_words").select(
        *(f"_kept{i}" for i in range(len(keep))),
        "body",
        F.size("words").cast("long").alias("n_words"),
        *(c.alias(name) for name, c in measures(F.col("body"), F.col("words")).items()),
        "n_repeat_words",
    )
    counted = with_slots(counted, "body", "own", buckets)
    total = F.aggregate("own", F.lit(0.0), lambda a, s: a + F.get(own, s))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATS * F.col("n_words"))
    judged = counted.withColumn("score", F.when(F.size("own") > 0, total / F.size("own")).otherwise(0.0)).withColumn("base_failed", failed)
    judged = judged.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
    return judged.select(*set_back(keep, DERIVED), *DERIVED)


def good_ids(labels: DataFrame) -> DataFrame:
    """The ids that the labels call good, each once."""
    return labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()


def trusted_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All documents that the labels call good."""
    return docs.join(good_ids(labels), "doc_id", "left_semi")


def corpus_and_trusted(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, limit_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """slot, raw and target: n-grams of all documents and of all trusted ones, from one pass over the texts."""
    good = broadcast_if_small(stage(good_ids(labels), "good_ids"), limit_bytes).withColumn("good", F.lit(1))
    narrow = "array<smallint>" if buckets <= 1 << 15 else "array<int>"
    reduced = with_slots(docs.select("doc_id", "text"), "text", "slots", buckets).select("doc_id", F.col("slots").cast(narrow).alias("slots"))
    each = reduced.join(good, "doc_id", "left").select("good", F.explode("slots").alias("slot"))
    return each.withColumn("slot", F.col("slot").cast("int")).groupBy("slot").agg(F.count("*").alias("raw"), F.count("good").alias("target"))


def op8_ngram_ratio_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base verdict and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = stage(corpus_and_trusted(docs, table(spark, sf_dir, "labels")), "slot_counts")
    corpus, trusted = (both.select("slot", F.col(side).alias("n")) for side in ("raw", "target"))
    weights = stage(ratio_weights(corpus, trusted), "ratio_weights")
    judged = apply_rules(docs, weights, keep=["doc_id"])
    return judged.select("doc_id", *MEASURES, "base_failed", "kept", "score")
