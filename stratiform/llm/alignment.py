"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes, and how often corpus-wide.

Texts are deduplicated exactly, by a shuffle of the full text. Each distinct text is encoded once by a
byte-level BPE (A, over a space and the text) and by a piece BPE (B, which adds that space itself), and cut
into groups where tokens of both end at one byte. All A-B pairs within a group are links. What a pair of ids
counts is the number of documents that hold it linked, so a distinct text adds its number of copies. The
measures are joined back to the documents by the SHA-256 of the text.

Counts meet the texts' pairs in two ways. Pairs frequent enough that at most `BROADCAST_PAIRS` are as frequent
go to every task; they are nearly all occurrences and all hot keys. The others are joined by a shuffle.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stratiform.llm.common import field, set_aside, set_back, table, text_slices, written_result
from stratiform.workspace import stage

VOCABULARIES = "/opt/tokenizers"
BYTE_VOCABULARY = "byte_bpe_50k.json"
PIECE_MODEL = "piece_bpe_32k.model"

#: Pairs of ids that are sent to every task, at some 50 bytes each.
BROADCAST_PAIRS = 1 << 20
#: Links of one group that are listed one by one; a larger group is listed by distinct ids and their counts.
GROUP_LINKS = 1 << 12
SLICE = 1 << 20
#: Characters without a change between space and none, beyond which the slower of two equal encoders is used.
LONG_RUN = 10_000

# Fixed value: the pattern by which byte-level BPE parts a text.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

MEASURES = ["n_a", "n_b", "n_groups", "n_links"]
DERIVED = [*MEASURES, "n_best", "count_sum", "groups_sha256"]


def byte_of_character() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: itself if it prints, else 256 and up in order."""
    printing = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printing]
    return {chr(b): b for b in printing} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteBpe:
    """A byte-level BPE from the content of its JSON file; `pool[id]` has the bytes of each entry.

    Where merges stand in the order of their ids, equal ids result from merging by rank, which is faster.
    The two encoders agree on every character; only very long runs are left to the tokenizer itself.
    """

    def __init__(self, content: bytes):
        described = json.loads(content)
        entries = dict(described["model"]["vocab"])
        added = {t["content"]: t["id"] for t in described.get("added_tokens", [])}
        bytes_of = byte_of_character()
        self.pool = [b""] * (max([*entries.values(), *added.values()]) + 1)
        for entry, i in entries.items():
            self.pool[i] = bytes(bytes_of[c] for c in entry)
        for entry, i in added.items():
            self.pool[i] = entry.encode()
        self.plain = Tokenizer.from_buffer(content)
        self.plain.encode_special_tokens = True
        self.plain.no_truncation()
        merged = [entries["".join(m if isinstance(m, list) else m.split(" "))] for m in described["model"]["merges"]]
        ordered = all(a < b for a, b in pairwise(merged))
        level = described.get("pre_tokenizer") or {}
        usual = level.get("type") == "ByteLevel" and level.get("use_regex", True) and not level.get("add_prefix_space") and not described.get("normalizer")
        self.fast = None
        if ordered and usual:
            ranks = {self.pool[i]: i for i in entries.values()}
            self.fast = tiktoken.Encoding("byte_level", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        words = text.split()
        longest = max(map(len, words), default=0)
        spaces = len(text) - sum(map(len, words)) - len(words)
        if self.fast is None or longest > LONG_RUN or spaces > LONG_RUN:
            return self.plain.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


class PieceBpe:
    """A piece BPE from the content of its model file; `pool[id]` has the bytes of each entry."""

    def __init__(self, content: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=content)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.pool = [
            bytes([int(p[1:-1], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


@lru_cache(maxsize=2)
def loaded(byte_vocabulary: bytes, piece_model: bytes) -> tuple[ByteBpe, PieceBpe]:
    """Both tokenizers, once per Python worker."""
    return ByteBpe(byte_vocabulary), PieceBpe(piece_model)


def joined(ids: list[int], pool: list[bytes]) -> bytes:
    return b"".join(map(pool.__getitem__, ids))


def span_counts(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For runs of the given lengths: the run of each element, and its place in the run."""
    run = np.repeat(np.arange(len(counts)), counts)
    return run, np.arange(len(run)) - np.repeat(np.cumsum(counts) - counts, counts)


class Alignment:
    """Groups of the tokens of several texts, each given by the ids of both tokenizers with equal joined bytes."""

    def __init__(self, a: list[list[int]], b: list[list[int]], bytes_a: np.ndarray, bytes_b: np.ndarray):
        self.texts = len(a)
        self.ids = [np.fromiter(chain.from_iterable(x), np.int64, sum(map(len, x))) for x in (a, b)]
        self.tokens = [np.array([len(x) for x in side], np.int64) for side in (a, b)]
        ends = [np.cumsum(w[x]) for w, x in zip((bytes_a, bytes_b), self.ids, strict=True)]
        marks = np.zeros((2, int(ends[0][-1]) + 1 if len(ends[0]) else 1), bool)
        for mark, end in zip(marks, ends, strict=True):
            mark[end] = True
        #: Whether a token is the last of its group, and the group of each token, on either side.
        self.last = [marks[1 - side][ends[side]] for side in (0, 1)]
        self.group = [np.cumsum(x) - x for x in self.last]
        groups = int(self.last[0].sum())
        self.size = [np.bincount(g, minlength=groups) for g in self.group]
        self.start = [np.cumsum(s) - s for s in self.size]
        last_token = np.cumsum(self.tokens[0]) - 1
        self.text_groups = np.diff(np.concatenate([[0], self.group[0][last_token] + 1]))
        self.text_of_group = np.repeat(np.arange(self.texts), self.text_groups)
        self.links = self.size[0] * self.size[1]

    def text_links(self) -> np.ndarray:
        return np.bincount(self.text_of_group, self.links, self.texts).astype(np.int64)

    def pairs(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text its distinct linked pairs, as a * width + b, ascending: text, pair and number of links."""
        small = self.links <= GROUP_LINKS
        rows = np.flatnonzero(small[self.group[0]])
        group = self.group[0][rows]
        run, place = span_counts(self.size[1][group])
        texts = [self.text_of_group[group][run]]
        found = [self.ids[0][rows][run] * width + self.ids[1][self.start[1][group][run] + place]]
        times = [np.ones(len(run), np.int64)]
        for g in np.flatnonzero(~small).tolist():
            sides = [x[s[g] : s[g] + n[g]] for x, s, n in zip(self.ids, self.start, self.size, strict=True)]
            (ua, ca), (ub, cb) = (np.unique(x, return_counts=True) for x in sides)
            found.append((ua[:, None] * width + ub).ravel())
            times.append((ca[:, None] * cb).ravel())
            texts.append(np.full(len(found[-1]), self.text_of_group[g]))
        text, pair, n = (np.concatenate(x) for x in (texts, found, times))
        order = np.lexsort((pair, text))
        text, pair, n = text[order], pair[order], n[order]
        begins = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (pair[1:] != pair[:-1])])) if len(text) else np.zeros(0, np.int64)
        return text[begins], pair[begins], np.add.reduceat(n, begins) if len(begins) else n

    def written(self, digits: np.ndarray, lengths: np.ndarray) -> list[bytes]:
        """The groups of each text: ids after commas, sides parted by a bar, groups by semicolons."""
        width = digits.shape[1]
        place_a = np.arange(len(self.ids[0])) + self.start[1][self.group[0]]
        ends_a = (self.start[0] + self.size[0])[self.group[1]]
        place_b = np.arange(len(self.ids[1])) + ends_a
        total = len(place_a) + len(place_b)
        ids, after = np.empty(total, np.int64), np.full(total, ord(","), np.uint8)
        ids[place_a], ids[place_b] = self.ids
        after[place_a[self.last[0]]] = ord("|")
        after[place_b[self.last[1]]] = ord(";")
        length = lengths[ids]
        letters = np.zeros((total, width + 1), np.uint8)
        letters[:, :width] = digits[ids]
        letters[np.arange(total), length] = after
        flat = letters[np.arange(width + 1) <= length[:, None]]
        ends = np.cumsum(length + 1)[np.cumsum(self.tokens[0] + self.tokens[1]) - 1]
        return [flat[i : j - 1].tobytes() for i, j in pairwise([0, *ends.tolist()])]


def decimal_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of 0 to n - 1 as bytes, left-aligned, and their lengths."""
    texts = [str(i).encode() for i in range(n)]
    width = max(map(len, texts))
    return np.frombuffer(b"".join(t.ljust(width, b"\0") for t in texts), np.uint8).reshape(n, width), np.array([len(t) for t in texts])


def aligned_texts(texts: DataFrame, vocabulary: object, with_groups: bool) -> DataFrame:
    """For each row of `texts` (key, copies, text): key, copies, measures, hash of the groups, linked pairs and their links.

    Texts that either tokenizer does not reproduce byte for byte are left out.
    """
    schema = "key string, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string, pairs array<long>, links array<long>"
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = loaded(*vocabulary.value)
        widths = [np.array([len(x) for x in t.pool]) for t in (first, second)]
        digits, lengths = decimal_table(max(map(len, widths)))
        for piece in text_slices(batches, "text", SLICE):
            texts = piece.column("text").to_pylist()
            a = [first.encode(" " + t) for t in texts]
            b = second.encode(texts)
            whole = [" ".encode() + t.encode() for t in texts]
            held = [i for i, w in enumerate(whole) if joined(a[i], first.pool) == w and joined(b[i], second.pool) == w]
            if not held:
                continue
            found = Alignment([a[i] for i in held], [b[i] for i in held], *widths)
            groups = found.written(digits, lengths)
            text, pair, links = found.pairs(len(second.pool))
            offsets = pa.array(np.searchsorted(text, np.arange(len(held) + 1)), pa.int32())
            rows = piece.take(pa.array(held))
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("key"),
                    rows.column("copies"),
                    *(pa.array(x, pa.int64()) for x in (*found.tokens, found.text_groups, found.text_links())),
                    pa.array([hashlib.sha256(g).hexdigest() for g in groups]),
                    pa.array([g.decode() for g in groups] if with_groups else [None] * len(held), pa.string()),
                    pa.ListArray.from_arrays(offsets, pa.array(pair, pa.int64())),
                    pa.ListArray.from_arrays(offsets, pa.array(links, pa.int64())),
                ],
                names,
            )

    return texts.select("key", "copies", "text").mapInArrow(run, schema)


def pair_counts(aligned: DataFrame, width: int) -> DataFrame:
    """pair, count (documents that hold it linked) and best (whether no pair of its A id counts more), written."""
    counted = aligned.select(F.explode("pairs").alias("pair"), "copies").groupBy("pair").agg(F.sum("copies").alias("count"))
    counted = stage(counted, "pair_counts")
    # One row per entry of A's vocabulary at most.
    most = counted.groupBy(first_id(F.col("pair"), width).alias("a")).agg(F.max("count").alias("most"))
    joined_ = counted.join(F.broadcast(most), first_id(F.col("pair"), width) == F.col("a"))
    return stage(joined_.select("pair", "count", (F.col("count") == F.col("most")).alias("best")), "pairs")


def first_id(pair: Column, width: int) -> Column:
    return F.floor(pair / F.lit(float(width))).cast("int")


def frequent_from(counts: DataFrame, most: int) -> int:
    """A count, a power of two, that at most `most` pairs reach; 1 if all of them may pass."""
    steps = counts.groupBy(F.floor(F.log2("count")).cast("int").alias("power")).agg(F.count("*").alias("n")).collect()
    held, least = 0, 1 << 62
    for power, n in sorted(((r["power"], r["n"]) for r in steps), reverse=True):
        held += n
        if held > most:
            return least
        least = 1 << power
    return 1


def count_measures(aligned: DataFrame, counts: DataFrame, most: int) -> DataFrame:
    """key, n_best and count_sum of the aligned texts."""
    sums = [
        F.sum(F.when(F.col("best"), F.col("links")).otherwise(F.lit(0))).alias("n_best"),
        F.sum(F.col("links") * F.col("count")).alias("count_sum"),
    ]
    linked = aligned.select("key", F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("links").alias("links")))).toDF("key", "pair", "links")
    least = frequent_from(counts, most)
    # At most `most` pairs reach that count.
    frequent = F.broadcast(counts.where(F.col("count") >= least))
    near = linked.join(frequent, "pair").groupBy("key").agg(*sums)
    if least == 1:
        return near
    rare = linked.join(frequent.select("pair"), "pair", "left_anti").join(counts.where(F.col("count") < least), "pair")
    both = near.union(rare.groupBy("key").agg(*sums))
    return both.groupBy("key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def file_content(path: str) -> bytes:
    with open(path, "rb") as source:
        return source.read()


def align_tokens(
    docs: DataFrame,
    text: str = "text",
    keep: list[str] | None = None,
    vocabularies: str = VOCABULARIES,
    byte_vocabulary: str = BYTE_VOCABULARY,
    piece_model: str = PIECE_MODEL,
    with_groups: bool = False,
    broadcast_pairs: int = BROADCAST_PAIRS,
) -> DataFrame:
    """The columns `keep` (default: all) with n_a, n_b (tokens), n_groups, n_links, n_best, count_sum and
    groups_sha256, and with `with_groups` the groups themselves, as `a1,a2|b1;a3|b2,b3`.

    n_best are the links whose pair counts as much as any of its A id, count_sum sums the counts of all links.
    Null and empty texts, and those that a tokenizer does not reproduce, have zeros and empty texts. Repeated
    rows each count as a document. Derived columns replace input columns of those names; others pass unread.
    The driver reads the vocabulary files (some megabytes) and sends them along. `docs` should be a scan: it
    is read twice.
    """
    spark: SparkSession = docs.sparkSession
    keep = docs.columns if keep is None else keep
    content = [file_content(os.path.join(vocabularies, f)) for f in (byte_vocabulary, piece_model)]
    width = sentencepiece.SentencePieceProcessor(model_proto=content[1]).get_piece_size()
    vocabulary = spark.sparkContext.broadcast(tuple(content))
    value = field(docs, text).cast("string")

    distinct = docs.select(value.alias("text")).where("text <> ''").groupBy("text").agg(F.count("*").alias("copies"))
    distinct = distinct.select(F.sha2("text", 256).alias("key"), "copies", "text")
    aligned = stage(aligned_texts(distinct, vocabulary, with_groups), "aligned_texts")
    counts = pair_counts(aligned, width)
    measured = count_measures(aligned, counts, broadcast_pairs)

    derived = [*DERIVED, *["groups"] * with_groups]
    own = aligned.select(F.col("key").alias("_key"), *MEASURES, "groups_sha256", *["groups"] * with_groups)
    sums = measured.select(F.col("key").alias("_key"), "n_best", "count_sum")
    rows = docs.select(*set_aside(docs, keep), F.sha2(value, 256).alias("_row_key"))
    found = rows.join(own.join(sums, "_key"), F.col("_row_key") == F.col("_key"), "left")
    texts_ = ("groups_sha256", "groups")
    made = [F.coalesce(c, F.lit("") if c in texts_ else F.lit(0).cast("long")).alias(c) for c in derived]
    return found.select(*set_back(keep, derived), *made)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens, groups and links of every document under both tokenizers."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return written_result(spark, "op11", lambda: align_tokens(docs, keep=["doc_id"]).select("doc_id", *DERIVED))
