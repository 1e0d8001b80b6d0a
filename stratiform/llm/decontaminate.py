"""Benchmark decontamination: an FM-index of each shard of documents, searched for test passages.

Tasks cut their documents into shards of about `SHARD_WORDS` words. A shard becomes a sequence of word
numbers, cut to the runs of words that some passage holds (shorter runs than the shortest window cannot
match), is suffix-sorted, and its Burrows-Wheeler transform is kept as a wavelet matrix. Passages are found by backward search through
wavelet ranks, their occurrences located by walking to the next sampled suffix position, and the spans of
a document merged. Nothing is shuffled.

Passages are the stated query set: they go to the tasks in blocks of about `block_bytes` of text, so no
broadcast grows with the benchmark. Each block is a job of its own: what it hits is written by text, and its
broadcast is gone before the next one is made.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.llm.common import ALNUM_WORDS, field, map_texts, table, text_bytes, text_slices, with_derived
from stratiform.workspace import stage

WINDOW = 13
SHARD_WORDS = 1_000_000
BLOCK_BYTES = 4 << 20
SAMPLE_EVERY = 32

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = {c: c + 32 for c in range(65, 91)}

SPAN = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
DERIVED = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("hit_spans", SPAN),
        T.StructField("hit_items", T.ArrayType(T.StringType())),
    ]
)


@dataclass
class Passages:
    """Windows of a block of benchmark items as word numbers; 0 ends a sequence, 1 is any other word."""

    vocabulary: dict[bytes, int]
    windows: np.ndarray  # one row per distinct window, right-aligned, padded with -1 on the left
    lengths: np.ndarray
    first_item: np.ndarray  # offsets into `items`
    items: np.ndarray
    names: list[str]


def passages(rows: list[tuple[str | None, str | None]], window: int) -> Passages:
    """The distinct windows of some items, some 150 bytes for each word of their texts while they are built."""
    vocabulary: dict[bytes, int] = {}
    names = sorted({"null" if name is None else name for name, _ in rows})
    number = {name: i for i, name in enumerate(names)}
    own: list[np.ndarray] = [np.zeros((0, window), np.int32)]
    items: list[np.ndarray] = [np.zeros(0, np.int32)]
    for name, text in rows:
        words = (text or "").encode().translate(ALNUM_WORDS).split()
        ids = np.fromiter((vocabulary.setdefault(w, len(vocabulary) + 2) for w in words), np.int32, len(words))
        if not len(ids):
            continue
        if len(ids) < window:
            ids = np.concatenate([np.full(window - len(ids), -1, np.int32), ids])
        own.append(np.lib.stride_tricks.sliding_window_view(ids, window))
        items.append(np.full(len(own[-1]), number["null" if name is None else name], np.int32))
    flat, item = np.concatenate(own), np.concatenate(items)
    order = np.lexsort((item, *flat.T[::-1]))
    flat, item = flat[order], item[order]
    new = np.concatenate([[True], (flat[1:] != flat[:-1]).any(1)]) if len(flat) else np.zeros(0, bool)
    other = np.concatenate([[True], new[1:] | (item[1:] != item[:-1])]) if len(flat) else new
    windows = flat[new]
    return Passages(
        vocabulary,
        windows,
        (windows >= 0).sum(1),
        np.searchsorted(np.cumsum(new)[other], np.arange(1, len(windows) + 2)),
        item[other],
        names,
    )


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes in order: four symbols at once, then doubling among equals only."""
    n = len(text)
    bits = max(1, int(text.max()).bit_length())
    depth = max(1, 62 // bits)
    padded = np.concatenate([text, np.zeros(depth, np.int64)])
    key = np.zeros(n, np.int64)
    for d in range(depth):
        key = (key << bits) | padded[d : d + n]
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    start = np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(start, np.arange(n), 0))
    slots = np.flatnonzero(~(start & np.append(start[1:], True)))
    while len(slots):
        members = order[slots]
        ahead = members + depth
        follow = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        group = rank[members]
        by = np.lexsort((follow, group))
        members, follow, group = members[by], follow[by], group[by]
        order[slots] = members
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (follow[1:] != follow[:-1])])
        rank[members] = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))]
        slots = slots[~(new & np.append(new[1:], True))]
        depth *= 2
    return order


class FMIndex:
    """Backward search and locate over a sequence that ends with its only 0."""

    def __init__(self, text: np.ndarray):
        order = suffix_order(text)
        n = len(text)
        self.bwt = text[order - 1]
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text))])
        self.levels = []
        current = self.bwt
        for level in range(max(1, int(text.max()).bit_length()) - 1, -1, -1):
            ones = (current >> level) & 1
            ranks = np.zeros(n + 1, np.int32)
            np.cumsum(ones, out=ranks[1:])
            zeros = n - int(ranks[n])
            self.levels.append((level, ranks, zeros))
            ones = ones.astype(bool)
            current = np.concatenate([current[~ones], current[ones]])
        sampled = order % SAMPLE_EVERY == 0
        self.sampled = sampled
        self.sample_rank = np.cumsum(sampled) - 1
        self.samples = order[sampled]

    def rank(self, symbol: np.ndarray, position: np.ndarray) -> np.ndarray:
        """How often each symbol occurs in the transform before each position."""
        begin = np.zeros_like(position)
        for level, ranks, zeros in self.levels:
            one = ((symbol >> level) & 1).astype(bool)
            p, b = ranks[position], ranks[begin]
            position = np.where(one, zeros + p, position - p)
            begin = np.where(one, zeros + b, begin - b)
        return position - begin

    def search(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows that occur, with their row ranges."""
        alive = np.arange(len(windows))
        low = np.zeros(len(windows), np.int64)
        high = np.full(len(windows), len(self.bwt), np.int64)
        for column in range(windows.shape[1] - 1, -1, -1):
            symbol = windows[alive, column]
            known = symbol < len(self.before) - 1
            use = (symbol >= 0) & known
            s = symbol[use]
            low[use] = self.before[s] + self.rank(s, low[use])
            high[use] = self.before[s] + self.rank(s, high[use])
            keep = (low < high) & known
            alive, low, high = alive[keep], low[keep], high[keep]
            if not len(alive):
                break
        return alive, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of transform rows."""
        at = rows.copy()
        found = np.full(len(rows), -1, np.int64)
        open_ = np.arange(len(rows))
        steps = 0
        while len(open_):
            here = at[open_]
            done = self.sampled[here]
            found[open_[done]] = self.samples[self.sample_rank[here[done]]] + steps
            open_ = open_[~done]
            here = here[~done]
            symbol = self.bwt[here]
            at[open_] = self.before[symbol] + self.rank(symbol, here)
            steps += 1
        return found


def search_shard(words: list[list[bytes]], wanted: Passages) -> tuple[list[list[tuple[int, int]]], list[set[str]]]:
    """Merged hit spans in words, and the items hit, of each document of a shard."""
    sizes = np.array([len(w) for w in words], np.int64)
    spans: list[list[tuple[int, int]]] = [[] for _ in words]
    items: list[set[str]] = [set() for _ in words]
    total = int(sizes.sum())
    if not total or not len(wanted.windows):
        return spans, items
    get = wanted.vocabulary.get
    # Each document is followed by one separator.
    begins = np.concatenate([[0], np.cumsum(sizes + 1)])
    flat = np.ones(int(begins[-1]), np.int32)
    for begin, doc in zip(begins.tolist(), words, strict=False):
        flat[begin : begin + len(doc)] = np.fromiter(map(get, doc, repeat(1)), np.int32, len(doc))
    # Only runs of known words that are as long as the shortest window can hold one.
    edges = np.flatnonzero(np.diff(np.concatenate([[0], (flat > 1).view(np.int8), [0]]))).reshape(-1, 2)
    edges = edges[edges[:, 1] - edges[:, 0] >= wanted.lengths.min()]
    if not len(edges):
        return spans, items
    taken = edges[:, 1] - edges[:, 0] + 1  # with the separator behind each run; the last word has one, too
    where = np.repeat(edges[:, 0] - np.concatenate([[0], np.cumsum(taken)[:-1]]), taken) + np.arange(int(taken.sum()))
    index = FMIndex(np.concatenate([flat[where], [0]]).astype(np.int64))
    found, low, high = index.search(wanted.windows)
    if not len(found):
        return spans, items
    counts = high - low
    rows = np.repeat(low - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(int(counts.sum()))
    which = np.repeat(found, counts)
    starts = where[index.locate(rows)]
    doc_of = np.searchsorted(begins, starts, "right") - 1
    by = np.argsort(starts, kind="stable")
    begin, end = starts[by], np.maximum.accumulate((starts + wanted.lengths[which])[by])
    first = np.concatenate([[True], begin[1:] > end[:-1]])  # spans that touch are one; a separator parts documents
    for d, a, b in zip(doc_of[by][first].tolist(), begin[first].tolist(), end[np.append(first[1:], True)].tolist(), strict=True):
        spans[d].append((a - int(begins[d]), b - int(begins[d])))
    for d, w in np.unique(np.stack([doc_of, which], 1), axis=0).tolist():
        items[d].update(wanted.names[i] for i in wanted.items[wanted.first_item[w] : wanted.first_item[w + 1]].tolist())
    return spans, items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _pass(docs: DataFrame, block: object, shard_words: int) -> DataFrame:
    """One block of passages against all documents; `docs` has row, text and what earlier passes found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = block.value
        waiting: list[pa.RecordBatch] = []
        words: list[list[bytes]] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            spans, items = search_shard(words, wanted)
            at = 0
            for piece in waiting:
                stop = at + piece.num_rows
                old_spans = piece.column("hit_spans").to_pylist()
                old_items = piece.column("hit_items").to_pylist()
                new_spans = [
                    [{"start": a, "end": b} for a, b in merged([(x["start"], x["end"]) for x in old] + new)]
                    for old, new in zip(old_spans, spans[at:stop], strict=True)
                ]
                new_items = [sorted({*old, *new}) for old, new in zip(old_items, items[at:stop], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("row"),
                        piece.column("text"),
                        pa.array([len(w) for w in words[at:stop]], pa.int64()),
                        pa.array(new_spans, piece.schema.field("hit_spans").type),
                        pa.array(new_items, piece.schema.field("hit_items").type),
                    ],
                    ["row", "text", "n_words", "hit_spans", "hit_items"],
                )
                at = stop

        for piece in text_slices(batches, "text", shard_words * 4):
            own = [b.translate(ALNUM_WORDS).split() for b in text_bytes(piece.column("text"))]
            added = sum(map(len, own))
            if waiting and size + added > shard_words:
                yield from flush()
                waiting, words, size = [], [], 0
            waiting.append(piece)
            words.extend(own)
            size += added
        if waiting:
            yield from flush()

    return docs.mapInArrow(run, docs.schema)


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """`docs` with n_words, hit_spans (merged word ranges, end exclusive) and hit_items (sorted ids).

    Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased. An item's windows are its
    runs of `window` words; a shorter item is one window; an item without words has none. Null and empty
    texts have no words and no hits; a null item id counts as the id "null"; items that share an id are one
    item; an empty benchmark hits nothing. Repeated rows are answered one by one. The derived columns
    replace input columns of the same name.
    """
    spark: SparkSession = docs.sparkSession
    queries = benchmark.select(
        field(benchmark, item_id).cast("string").alias("name"), field(benchmark, item_text).cast("string").alias("body")
    ).distinct()
    total = queries.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    value = field(docs, text).cast("string")

    def searched(row: Column, block: object) -> DataFrame:
        nothing = [F.lit(0).cast("long").alias("n_words"), F.array().cast(SPAN).alias("hit_spans"), F.array().cast("array<string>").alias("hit_items")]
        return _pass(docs.select(row.alias("row"), value.alias("text"), *nothing), block, shard_words)

    def block_of(part: DataFrame) -> object:
        return spark.sparkContext.broadcast(passages([(r["name"], r["body"]) for r in part.toLocalIterator()], window))

    if blocks == 1:
        whole = F.struct(*(field(docs, c) for c in docs.columns))
        return with_derived(searched(whole, block_of(queries)), "row", DERIVED.names)

    hits = None
    for b in range(blocks):
        block = block_of(queries.where(F.pmod(F.xxhash64("name", "body"), F.lit(blocks)) == b))
        found = searched(F.struct(*text_hashes(value)), block).where(F.size("hit_spans") > 0)
        found = stage(found.select("row.*", "hit_spans", "hit_items").dropDuplicates(["h1", "h2"]), "block_hits")
        block.destroy()
        hits = found if hits is None else hits.union(found)
    # At most one row per block and text.
    of_text = hits.groupBy("h1", "h2").agg(
        F.flatten(F.collect_list("hit_spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("hit_items")))).alias("items")
    )
    of_text = of_text.select(F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), merged_spans("spans").alias("_spans"), F.col("items").alias("_items"))
    counted = map_texts(docs, text, T.StructType([DERIVED["n_words"]]), lambda texts: {"n_words": [len(b.translate(ALNUM_WORDS).split()) for b in text_bytes(texts)]})
    own = [h == F.col(name) for h, name in zip(text_hashes(field(counted, text).cast("string")), ("_h1", "_h2"), strict=True)]
    joined = counted.join(of_text, own[0] & own[1], "left")
    kept = [field(joined, c) for c in docs.columns if c not in DERIVED.names]
    spans = F.coalesce("_spans", F.array().cast(SPAN)).alias("hit_spans")
    return joined.select(*kept, "n_words", spans, F.coalesce("_items", F.array().cast("array<string>")).alias("hit_items"))


def text_hashes(text: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes; of null as of an empty text."""
    body = F.coalesce(text, F.lit(""))
    return F.xxhash64(body).alias("h1"), F.xxhash64(F.lit(1), body).alias("h2")


@F.pandas_udf(SPAN)
def merged_spans(spans: pd.Series) -> pd.Series:
    return pd.Series([[{"start": a, "end": b} for a, b in merged([(x["start"], x["end"]) for x in own])] for own in spans])


def n_hit() -> Column:
    return F.aggregate("hit_spans", F.lit(0).cast("long"), lambda total, s: total + (s["end"] - s["start"]))


def contaminated() -> Column:
    """The rule: some hit, and at least a twentieth of the words."""
    return (n_hit() > 0) & (20 * n_hit() >= F.col("n_words"))


def remove_passages(found: DataFrame, text: str = "text") -> DataFrame:
    """The result of `find_passages` with every hit span cut from its text; a null text stays null."""

    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([cut_words(t, s) for t, s in zip(texts, spans, strict=True)], dtype=object)

    return found.withColumn(text, F.pandas_udf(cut, "string")(field(found, text), F.col("hit_spans")))


def cut_words(text: str | None, spans: list | None) -> str | None:
    """A text without the words of the spans and what stands between them."""
    if text is None or spans is None or not len(spans):
        return text
    words = [m.span() for m in WORD.finditer(text.translate(FOLD))]
    at, out = 0, []
    for span in spans:
        out.append(text[at : words[span["start"]][0]])
        at = words[span["end"] - 1][1]
    return "".join([*out, text[at:]])


def op9_fm_index_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: words, hit words, items with occurring windows, verdict."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_passages(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        n_hit().alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "hit_items"), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


def stage_decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule calls contaminated go; the others stay as they are."""
    found = find_passages(docs, table(spark, sf_dir, "benchmark"))
    return found.where(~contaminated()).select(*docs.columns)


ORACLE_SQL = {
    "op9_fm_index_decontamination": r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(13, len(ws)) AS k, array_to_string(ws[i:i + least(13, len(ws)) - 1], ' ') AS g
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 13, 0) + 2)) AS i FROM b WHERE len(ws) > 0)
), ks AS (
  SELECT DISTINCT k FROM bw
), dw AS (
  SELECT doc_id, k, i, array_to_string(ws[i:i + k - 1], ' ') AS g
  FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, ks WHERE len(ws) >= k)
), hits AS (
  SELECT dw.doc_id, dw.i, dw.k, bw.item_id FROM dw JOIN bw USING (k, g)
), marked AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT doc_id, i, k FROM hits)) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM w LEFT JOIN marked USING (doc_id) LEFT JOIN named USING (doc_id)
"""
}
