"""Ranked lexical search by norm buckets: the best documents of every item, exactly.

A document is a sparse vector of impacts, an item one of term weights; a score is their product. As in LEMP,
impact vectors are ordered by length and cut into buckets. A bucket is passed over for an item when the
Cauchy-Schwarz bound of its longest vector stays below the item's threshold. Inside a bucket the item's
heaviest coordinates are looked up first, so many that no vector without one of them can reach the threshold;
the partial product and the lengths of what is left on both sides bound every score. Survivors are scored
again in 64-bit integers.

Thresholds start from the exact result over a bounded sample of the documents, a lower bound of the true one,
and rise inside each task, which hands on no more than its own best of each item. Vectors hold only terms
that an item has. Each task orders its own vectors, so nothing but those results is shuffled. Items are
worked on in blocks of bounded size, each in jobs of its own.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from stratiform.llm.common import ALNUM_WORDS, field, table, text_bytes, text_slices, written_result
from stratiform.workspace import stage

BEST = 20
#: Bytes of terms and weights of the items worked on at once; one item is never parted.
BLOCK_BYTES = 8 << 20
SAMPLE = 1 << 13
BUCKET = 1 << 11
CHUNK_ENTRIES = 1 << 21
SLACK = 1 + 1e-9


def term_counts(text: bytes) -> Counter:
    """How often each term occurs: runs of letters, digits and all beyond ASCII, with A-Z lower-cased."""
    return Counter(text.translate(ALNUM_WORDS).split())


def item_terms(items: DataFrame) -> DataFrame:
    """item, term and times, from `items` (item, text). Rows of one id are one item."""
    schema = T.StructType([T.StructField("item", items.schema["item"].dataType), *T.StructType.fromDDL("term string, times long").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in text_slices(batches, "text"):
            counted = [term_counts(t) for t in text_bytes(piece.column("text"))]
            owner = np.repeat(np.arange(len(counted)), [len(c) for c in counted])
            terms = pa.array([t.decode() for c in counted for t in c], pa.string())
            times = pa.array([n for c in counted for n in c.values()], pa.int64())
            yield pa.RecordBatch.from_arrays([piece.column("item").take(pa.array(owner)), terms, times], ["item", "term", "times"])

    return items.mapInArrow(run, schema).groupBy("item", "term").agg(F.sum("times").alias("times"))


def term_vectors(docs: DataFrame, vocabulary: object) -> DataFrame:
    """doc, n (all terms of the text), and the vocabulary's terms in it: numbers and occurrences. Only texts with terms."""
    schema = T.StructType([T.StructField("doc", docs.schema["doc"].dataType), *T.StructType.fromDDL("n long, terms array<int>, times array<int>").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value
        for piece in text_slices(batches, "text"):
            counted = [term_counts(t) for t in text_bytes(piece.column("text"))]
            n = np.array([c.total() for c in counted], np.int64)
            known = [[(number[t], k) for t, k in c.items() if t in number] for c in counted]
            held = np.flatnonzero(n)
            ends = np.concatenate([[0], np.cumsum([len(known[i]) for i in held])])
            flat = np.array([x for i in held for x in known[i]], np.int32).reshape(-1, 2)
            offsets = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(flat[:, j]))) for j in (0, 1)]
            yield pa.RecordBatch.from_arrays([piece.column("doc").take(pa.array(held)), pa.array(n[held]), *lists], ["doc", "n", "terms", "times"])

    return docs.mapInArrow(run, schema)


class Queries:
    """Items as sparse weight vectors, heaviest coordinates first, with the length of what follows each."""

    def __init__(self, ids: pa.Array, vectors: list[tuple[np.ndarray, np.ndarray]], size: int, documents: int, terms: int):
        self.ids, self.size, self.documents, self.terms = ids, size, documents, terms
        self.vectors = []
        for number, weight in vectors:
            order = np.lexsort((number, -weight))
            self.vectors.append((number[order], weight[order]))
        self.rest = [np.sqrt(np.concatenate([np.cumsum((w.astype(np.float64) ** 2)[::-1])[::-1], [0.0]])) for _, w in self.vectors]
        self.length = np.array([r[0] for r in self.rest])
        self.least = np.ones(len(vectors), np.int64)


class Bucket:
    """Impact vectors of about one length: by vector and by coordinate."""

    def __init__(self, owner: np.ndarray, term: np.ndarray, impact: np.ndarray, length: np.ndarray, size: int):
        self.length, self.impact, self.term = length, impact, term
        self.begin = np.searchsorted(owner, np.arange(len(length) + 1))
        by = np.argsort(term, kind="stable")
        self.posting, self.posted = owner[by], impact[by].astype(np.float64)
        self.terms, first = np.unique(term[by], return_index=True)
        self.first = np.append(first, len(term))

    def places(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The positions of all stretches begin to end, one after the other."""
        n = end - begin
        return np.repeat(begin - np.cumsum(n) + n, n) + np.arange(int(n.sum()))

    def survivors(self, number: np.ndarray, weight: np.ndarray, rest: np.ndarray, least: int) -> np.ndarray:
        """Vectors whose score may reach `least`, by their lengths and the item's heaviest coordinates."""
        able = int(np.searchsorted(-self.length, -least / (rest[0] * SLACK), "right"))
        focus = int(np.searchsorted(-rest, -least / (self.length[0] * SLACK), "right"))
        at = np.searchsorted(self.terms, number[:focus])
        there = at < len(self.terms)
        there[there] = self.terms[at[there]] == number[:focus][there]
        at = at[there]
        begin, end = self.first[at], self.first[at + 1]
        place = self.places(begin, end)
        vector, impact = self.posting[place], self.posted[place]
        partial = np.bincount(vector, impact * np.repeat(weight[:focus][there].astype(np.float64), end - begin), len(self.length))
        seen = np.bincount(vector, impact * impact, len(self.length))
        bound = partial + rest[min(focus, len(rest) - 1)] * np.sqrt(np.maximum(self.length * self.length - seen, 0))
        return np.flatnonzero(bound[:able] * SLACK >= least)

    def scores(self, vectors: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Exact products in integers."""
        begin, end = self.begin[vectors], self.begin[vectors + 1]
        place = self.places(begin, end)
        sums = np.concatenate([[0], np.cumsum(weights[self.term[place]] * self.impact[place])])
        stop = np.cumsum(end - begin)
        return sums[stop] - sums[stop - (end - begin)]


def chunks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows in tables of about `CHUNK_ENTRIES` coordinates."""
    held, entries = [], 0
    for batch in batches:
        held.append(batch)
        entries += pc.sum(pc.list_value_length(batch.column("terms"))).as_py() or 0
        if entries > CHUNK_ENTRIES:
            yield pa.Table.from_batches(held).combine_chunks()
            held, entries = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def buckets_of(chunk: pa.Table, queries: Queries) -> Iterator[tuple[Bucket, np.ndarray]]:
    """Buckets of a chunk's impact vectors, longest first, with the row of each vector."""
    n = chunk.column("n").to_numpy()
    count = pc.list_value_length(chunk.column("terms")).to_numpy()
    term, times = (pc.list_flatten(chunk.column(c)).to_numpy().astype(np.int64) for c in ("terms", "times"))
    norm = 75 + (25 * n * queries.documents) // queries.terms
    row = np.repeat(np.arange(len(n)), count)
    impact = (1_000_000_000 * times) // (1000 * times + 12 * norm[row])
    length = np.sqrt(np.bincount(row, impact.astype(np.float64) ** 2, len(n)))
    order = np.lexsort((np.arange(len(n)), -length))
    order = order[: int((length > 0).sum())]
    begin = np.cumsum(count) - count
    for i in range(0, len(order), BUCKET):
        rows = order[i : i + BUCKET]
        size = count[rows]
        place = np.repeat(begin[rows] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
        owner = np.repeat(np.arange(len(rows)), size)
        yield Bucket(owner, term[place], impact[place], length[rows], queries.size), rows


def search(vectors: DataFrame, queries: object, item: T.DataType, best: int) -> DataFrame:
    """item, doc and score: at least the best of every item, at most `best` of each from one task."""
    schema = T.StructType([T.StructField("item", item), T.StructField("doc", vectors.schema["doc"].dataType), T.StructField("score", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = queries.value
        least = asked.least.copy()
        top: list[list[tuple]] = [[] for _ in asked.vectors]
        weights = np.zeros(asked.size, np.int64)
        for chunk in chunks_of(batches):
            ids = chunk.column("doc").combine_chunks()
            place = pc.rank(ids, sort_keys="ascending", null_placement="at_end", tiebreaker="first").to_numpy()
            for bucket, rows in buckets_of(chunk, asked):
                for q in np.flatnonzero(asked.length * bucket.length[0] * SLACK >= least).tolist():
                    number, weight = asked.vectors[q]
                    found = bucket.survivors(number, weight, asked.rest[q], int(least[q]))
                    if not len(found):
                        continue
                    weights[number] = weight
                    score = bucket.scores(found, weights)
                    weights[number] = 0
                    found, score = rows[found[score >= least[q]]], score[score >= least[q]]
                    first = np.lexsort((place[found], -score))[:best]
                    own = zip(score[first].tolist(), ids.take(pa.array(found[first])).to_pylist(), strict=True)
                    merged = sorted([*top[q], *own], key=lambda r: (-r[0], r[1] is None, r[1] if r[1] is not None else 0))
                    top[q] = merged[:best]
                    if len(top[q]) == best:
                        least[q] = max(least[q], top[q][-1][0])
        owner = [q for q, rows in enumerate(top) for _ in rows]
        if owner:
            arrays = [asked.ids.take(pa.array(owner)), pa.array([r[1] for t in top for r in t], ids.type), pa.array([r[0] for t in top for r in t], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["item", "doc", "score"])

    return vectors.mapInArrow(run, schema)


def ranked(found: DataFrame, best: int) -> DataFrame:
    """The rank of each row under its item, up to `best`; equal scores by ascending id, null last."""
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)


def item_blocks(terms: DataFrame, block_bytes: int) -> DataFrame:
    """`terms` with a block number: blocks of at most `block_bytes`, or of one item."""
    sized = terms.groupBy("item").agg(F.sum(F.octet_length("term") + 24).alias("bytes"))
    total = sized.agg(F.sum("bytes")).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    while blocks > 1:
        # One row per block.
        fullest = sized.groupBy(F.pmod(F.xxhash64("item"), F.lit(blocks)).alias("block")).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("items"))
        if fullest.where((F.col("items") > 1) & (F.col("bytes") > 2 * block_bytes)).isEmpty() or blocks > 1 << 20:
            break
        blocks *= 2
    return terms.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int"))


def rank_block(docs: DataFrame, terms: DataFrame, best: int, sample: int) -> DataFrame:
    """item, rank, doc and score for the items of one block of `terms` (item, term, times)."""
    spark = docs.sparkSession
    # At most twice BLOCK_BYTES, or one item.
    asked = terms.toArrow().combine_chunks()
    vocabulary = {t: i for i, t in enumerate(sorted({t.encode() for t in asked.column("term").to_pylist()}))}
    vectors = stage(term_vectors(docs, spark.sparkContext.broadcast(vocabulary)), "term_vectors")
    documents, length = vectors.agg(F.count("*"), F.sum("n")).first()
    item = to_arrow_schema(terms.schema).field("item").type
    if not documents or not len(asked):
        return ranked(spark.createDataFrame([], T.StructType([T.StructField("item", terms.schema["item"].dataType), T.StructField("doc", docs.schema["doc"].dataType), T.StructField("score", T.LongType())])), best)
    # One row per term of the block.
    holding = dict(vectors.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow().to_pandas().itertuples(index=False))
    weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * holding.get(i, 0) + 1))) for i in range(len(vocabulary))], np.int64)

    ids = asked.column("item").to_pylist()
    names = list(dict.fromkeys(ids))
    place = {name: i for i, name in enumerate(names)}
    per: list[list[tuple[int, int]]] = [[] for _ in names]
    for name, term, times in zip(ids, asked.column("term").to_pylist(), asked.column("times").to_pylist(), strict=True):
        number = vocabulary[term.encode()]
        if weight[number]:
            per[place[name]].append((number, times * int(weight[number])))
    held = [i for i, terms_ in enumerate(per) if terms_]
    pairs = [np.array(per[i], np.int64) for i in held]
    queries = Queries(pa.array([names[i] for i in held], item), [(p[:, 0], p[:, 1]) for p in pairs], len(vocabulary), documents, length)
    kind = terms.schema["item"].dataType
    if documents > 2 * sample:
        part = vectors.where(F.pmod(F.xxhash64("doc", "n"), F.lit(math.ceil(documents / sample))) == 0)
        low = ranked(search(part, spark.sparkContext.broadcast(queries), kind, best), best).where(F.col("rank") == best)
        reached = {r["item"]: r["score"] for r in low.select("item", "score").collect()}
        queries.least = np.array([max(1, reached.get(names[i], 1)) for i in held], np.int64)
    return ranked(search(vectors, spark.sparkContext.broadcast(queries), kind, best), best)


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    item_text: str = "text",
    item_id: str = "item_id",
    best: int = BEST,
    block_bytes: int = BLOCK_BYTES,
    sample: int = SAMPLE,
) -> DataFrame:
    """item_id, rank (from 1), doc_id and score: the `best` highest-scoring documents of every item, above 0.

    With N documents that have a term, L their terms, n those of a document and df the documents holding a
    term, a term weighs w = floor(1000 * ln((2N + 2) / (2df + 1))), and a document scores, over the item's terms with
    repeats, the sum of w * ((10^9 * tf) div (1000 * tf + 12 * (75 + (25 * n * N) div L))). Equal scores stand by
    ascending id, null last. Null and empty texts have no terms: such documents count nowhere, such items have no rows.
    Every row is a document, also a repeated one; rows of one item id are one item. Other columns are not read.
    """
    spark = docs.sparkSession
    wanted = docs.select(field(docs, doc_id).alias("doc"), field(docs, text).cast("string").alias("text"))
    given = items.select(field(items, item_id).alias("item"), field(items, item_text).cast("string").alias("text"))
    terms = stage(item_blocks(stage(item_terms(given), "item_terms"), block_bytes), "item_blocks")
    blocks = [r["block"] for r in terms.select("block").distinct().collect()] or [0]
    found = None
    for block in sorted(blocks):
        own = terms.where(F.col("block") == block).drop("block")
        done = written_result(spark, "ranked", lambda own=own: rank_block(wanted, own, best, sample))
        found = done if found is None else found.union(done)
    return found.select(F.col("item").alias("item_id"), F.col("rank").cast("int").alias("rank"), F.col("doc").alias("doc_id"), "score")


def op12_norm_bucket_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest-scoring documents of each benchmark item."""
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return written_result(spark, "op12", lambda: rank_documents(docs, items))


_TERMS = r"unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"

ORACLE_SQL = {
    "op12_norm_bucket_search": f"""
WITH d AS (
  SELECT doc_id, {_TERMS} AS t FROM documents
), f AS (
  SELECT doc_id, t, count(*) AS tf FROM d GROUP BY ALL
), n AS (
  SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id
), c AS (
  SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM n
), w AS (
  SELECT t, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM f, c GROUP BY t, docs
), q AS (
  SELECT item_id, t, count(*) AS times FROM (SELECT item_id, {_TERMS} AS t FROM benchmark) GROUP BY ALL
), s AS (
  SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms)))) AS BIGINT) AS score
  FROM q JOIN f USING (t) JOIN w USING (t) JOIN n USING (doc_id), c GROUP BY ALL
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 20
"""
}
