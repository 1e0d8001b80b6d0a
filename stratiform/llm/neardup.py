"""N-gram Jaccard join by prefix trees: which documents share 80 % of their word shingles, and the groups.

1. Documents with equal texts become one node, known by a 128-bit hash; one text of each is written once,
   bucketed by its number, and every later join with texts reuses the buckets.
2. Shingles get a global order, rare ones first. The frequency of a shingle is that of its slot in a counter
   table of fixed size; any order gives right results, a good one meets few strangers.
3. Nodes that share a band of minimum hashes are verified against four of them. These links already connect
   most near copies, and nodes that are connected need not be compared again.
4. The first fifth of each ordered set, enough to meet every partner's, is dealt out by shingle, one entry for
   each connected group. A shingle stays only if groups meet there that can reach the overlap by length and position.
5. Nodes that share such a shingle come to one home. Shingles met by the same few groups have one home, and so
   have more frequent shingles that occur together, so that a pair meets in few places. A home is cut into tiles of
   bounded bytes, and each pair of tiles is a unit of work of its own.
6. Parity signatures, made with the bands and a small part of a text in size, bound the difference of two sets from
   below. They go to the units of work first, and a unit gets the texts only of those members that they leave a
   partner in another group: most that meet by chance have none, and there are the more of these the larger the corpus is.
7. The ordered sets of a tile stand in a trie, which is walked with each set of the other tile, counting shared
   starts once and leaving a path when what remains cannot reach the overlap. Pairs whose groups have become
   connected are passed over. Only links that connect two groups leave the task.
8. Components of all links, by star steps in Spark. No link between different groups is lost; links inside a
   group need not be listed.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.llm import shingles as sh
from stratiform.llm.common import field, table, text_bytes, text_slices, written_result
from stratiform.llm.components import components
from stratiform.operators.lookup import broadcast_if_small
from stratiform.operators.numbering import number_rows
from stratiform.workspace import new_path, remove_path, stage

SIMILAR = 0.8
#: What texts with words match: a byte that `bytes.split` does not take for white space.
WORD = "[^ \t-\r]"
BUCKET_BYTES = 64 << 20
MOST_BUCKETS = 100_000
WORDS_PER_SLOT = 256
#: Counters of one task, whatever the size of the input: 4 MiB written, and as much work for each slice of text.
MOST_SLOTS = 1 << 20
SLICE = 1 << 12
POSTINGS_PER_PART = 250_000
TEXT_BYTES = 1 << 20
CHUNK = 512
#: Groups at a shingle up to which pairs are formed to see whether any can link.
SHORT = 64
#: Groups at a shingle up to which its home is named after them.
FEW = 4
TILE_ROWS = 256
TILE_BYTES = 1 << 20
TILES_PER_GROUP = 16

BANDS = [f"b{i}" for i in range(sh.BANDS)]


def sign_and_count(texts: DataFrame, slots: int) -> DataFrame:
    """Rows of two kinds from one pass over `texts` (no, id, text).

    Nodes: no, id, the size n of the shingle set, bytes of the text, its bands and signature. Counts: a slice of the counter
    table, and how often each of its slots occurs in the task's sets.
    """
    width = min(SLICE, slots)
    schema = T.StructType(
        [texts.schema["no"], texts.schema["id"], *(T.StructField(c, T.LongType()) for c in ("n", "bytes", *BANDS))]
        + [T.StructField("signature", T.BinaryType()), T.StructField("slice", T.IntegerType()), T.StructField("counts", T.BinaryType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = sh.WordHashes()
        counts = np.zeros(slots, np.int64)
        kind = pa.null()
        for piece in text_slices(batches, "text", TEXT_BYTES):
            kind = piece.column("id").type
            sets = sh.shingle_sets(text_bytes(piece.column("text")), hashes)
            counts += np.bincount(sh.slot_of(np.concatenate(sets), slots), minlength=slots)
            n = np.array([len(s) for s in sets], np.int64)
            size = pc.binary_length(piece.column("text")).to_numpy(zero_copy_only=False).astype(np.int64)
            yield whole(piece.column("no"), piece.column("id"), n, size, *sh.band_keys(sets).T, signatures=sh.packed_signatures(sets))
        parts = np.minimum(counts, 2**32 - 1).astype(np.uint32).reshape(-1, width)
        for i in np.flatnonzero(parts.any(1)).tolist():
            yield whole(pa.nulls(1, pa.int64()), pa.nulls(1, kind), slice_=i, counts=parts[i].tobytes())

    def whole(
        no: pa.Array, id_: pa.Array, *numbers: np.ndarray, signatures: list[bytes] | None = None, slice_: int | None = None, counts: bytes | None = None
    ) -> pa.RecordBatch:
        size = len(no)
        longs = [pa.array(x, pa.int64()) for x in numbers] or [pa.nulls(size, pa.int64())] * (2 + sh.BANDS)
        extra = [pa.array(signatures or [None] * size, pa.binary()), pa.array([slice_] * size, pa.int32()), pa.array([counts] * size, pa.binary())]
        return pa.RecordBatch.from_arrays([no, id_, *longs, *extra], ["no", "id", "n", "bytes", *BANDS, "signature", "slice", "counts"])

    return texts.select("no", "id", "text").mapInArrow(run, schema)


def frequency_classes(counted: DataFrame, slots: int) -> np.ndarray:
    """A class from 0 to 255 for each counter slot: four times the binary logarithm of its count."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = np.frombuffer(blob, np.uint32).astype(np.int64)
                sums[i] = sums[i] + own if i in sums else own
        for i, own in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([own.tobytes()], pa.binary())], ["slice", "counts"])

    classes = np.zeros(slots, np.uint8)
    width = min(SLICE, slots)
    for r in counted.select("slice", "counts").repartition("slice").mapInArrow(add, "slice int, counts binary").toLocalIterator():
        own = np.frombuffer(r["counts"], np.int64)
        classes[r["slice"] * width : (r["slice"] + 1) * width] = np.minimum(255, np.round(4 * np.log2(np.maximum(own, 1))))
    return classes


def similarity_pairs(pairs: DataFrame, texts: DataFrame, classes: object) -> DataFrame:
    """Of `pairs` (a, b, least): a, b, sizes na and nb, overlap, linked and distance of those with a similarity of at least `least`.

    Pairs are grouped by a, in chunks of about `CHUNK`; a chunk gets the text of a once and those of its b's.
    """
    sizes = pairs.groupBy("a").agg(F.ceil(F.count("*") / CHUNK).alias("chunks"))
    dealt = pairs.join(sizes, "a").withColumn("chunk", F.pmod(F.xxhash64("b"), F.col("chunks")).cast("int")).drop("chunks")
    nothing = F.lit(None)
    probes = dealt.select("a", "chunk").distinct().join(texts.select(F.col("no").alias("a"), "text"), "a")
    others = dealt.join(texts.select(F.col("no").alias("b"), "text"), "b")
    both = probes.select("a", "chunk", nothing.cast("long").alias("b"), nothing.cast("double").alias("least"), "text").union(
        others.select("a", "chunk", "b", "least", "text")
    )
    grouped = both.repartition("a", "chunk").sortWithinPartitions("a", "chunk", F.col("b").asc_nulls_first())

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for piece in text_slices(batches, "text", TEXT_BYTES):
            columns = [piece.column(c).to_pylist() for c in ("a", "chunk", "b", "least")]
            yield from zip(*columns, text_bytes(piece.column("text")), strict=True)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = sh.WordHashes()
        order = classes.value
        out: list[tuple] = []
        for (a, _), group in groupby(rows(batches), key=lambda r: r[:2]):
            probe = sh.in_order(sh.shingle_sets([next(group)[4]], hashes)[0], order)
            while block := [r for _, r in zip(range(CHUNK), group)]:
                sets = [sh.in_order(s, order) for s in sh.shingle_sets([r[4] for r in block], hashes)]
                needed = [math.ceil(r[3] / (1 + r[3]) * (len(probe) + len(s)) - 1e-9) for r, s in zip(block, sets, strict=True)]
                found = sh.Trie(sets).overlaps(probe, needed)
                out += [(a, r[2], len(probe), len(s), o) for r, s, o in zip(block, sets, found, strict=True) if o >= 0]
            if len(out) > 10_000:
                yield batch_of(out)
                out = []
        if out:
            yield batch_of(out)

    def batch_of(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], ["a", "b", "na", "nb", "overlap"])

    measured = grouped.mapInArrow(verify, "a long, b long, na long, nb long, overlap long")
    union = F.col("na") + F.col("nb") - F.col("overlap")
    return measured.select("*", (100 * F.col("overlap") >= 80 * union).alias("linked"), (1 - F.col("overlap") / union).alias("distance"))


def band_links(nodes: DataFrame, texts: DataFrame, classes: object) -> DataFrame:
    """Verified links (a, b, nb, distance, added), a < b, of nodes with four nodes of each of their bands.

    The four are the first and last by key and by a hash of it, so that a group whose members hardly link
    with one of them is still connected by the others. `added` is how many shingles b has that a has not.
    """
    banded = nodes.select("no", F.posexplode(F.array(*BANDS)).alias("band", "key"))
    hashed = F.struct(F.xxhash64("no").alias("h"), "no")
    hubs = banded.groupBy("band", "key").agg(
        F.array(F.min("no"), F.max("no"), F.min(hashed)["no"], F.max(hashed)["no"]).alias("hubs"), F.count("*").alias("size")
    )
    near = banded.join(hubs.where("size > 1").drop("size"), ["band", "key"]).select("no", F.explode(F.array_distinct("hubs")).alias("hub"))
    pairs = near.where("no <> hub").select(F.least("no", "hub").alias("a"), F.greatest("no", "hub").alias("b")).distinct()
    checked = similarity_pairs(pairs.withColumn("least", F.lit(SIMILAR)), texts, classes)
    return stage(checked.where("linked").select("a", "b", "nb", "distance", (F.col("nb") - F.col("overlap")).alias("added")), "band_links")


ENTRY = np.dtype([("token", "<u4"), ("group", "<i8"), ("least", "<i4"), ("most", "<i4"), ("rest", "<i4")])


def combined(entries: np.ndarray) -> np.ndarray:
    """One entry per token and group: smallest and largest set size, largest number of elements behind."""
    entries = entries[np.lexsort((entries["group"], entries["token"]))]
    new = np.concatenate([[True], (entries["token"][1:] != entries["token"][:-1]) | (entries["group"][1:] != entries["group"][:-1])])
    begins = np.flatnonzero(new)
    out = entries[begins].copy()
    out["least"] = np.minimum.reduceat(entries["least"], begins)
    out["most"] = np.maximum.reduceat(entries["most"], begins)
    out["rest"] = np.maximum.reduceat(entries["rest"], begins)
    return out


def prefix_tokens(first: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The part and the number within it of each element of a prefix."""
    mixed = sh.mixed(first)
    return ((mixed >> np.uint64(32)) % np.uint64(parts)).astype(np.int64), (mixed & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def prefixes(batches: Iterator[pa.RecordBatch], order: np.ndarray) -> Iterator[tuple[dict, int, np.ndarray]]:
    """For each row (group, text and more): the row without its text, the size of its set, and the prefix."""
    hashes = sh.WordHashes()
    for piece in text_slices(batches, "text", TEXT_BYTES):
        others = [c for c in piece.schema.names if c != "text"]
        for row, s in zip(piece.select(others).to_pylist(), sh.shingle_sets(text_bytes(piece.column("text")), hashes), strict=True):
            yield row, len(s), sh.in_order(s, order)[: sh.prefix_length(len(s))]


def meeting_groups(texts: DataFrame, groups: DataFrame, classes: object, parts: int) -> DataFrame:
    """token, home and group: shingles in the prefixes of groups that can link there.

    home tells shingles that the same groups meet at; for those of more than `FEW` groups it is null.
    """
    owned = texts.join(groups, "no", "left").select(F.coalesce("component", "no").alias("group"), "text")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] = []
        part_of: list[np.ndarray] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            entries, part = np.concatenate(waiting), np.concatenate(part_of)
            by = np.argsort(part, kind="stable")
            entries, part = entries[by], part[by]
            cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])).tolist()
            numbers = [int(part[c]) for c in cuts]
            blobs = [combined(entries[i:j]).tobytes() for i, j in zip(cuts, [*cuts[1:], len(part)], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(blobs, pa.binary())], ["part", "entries"])

        for row, n, first in prefixes(batches, classes.value):
            part, token = prefix_tokens(first, parts)
            own = np.empty(len(first), ENTRY)
            own["token"], own["group"], own["least"], own["most"] = token, row["group"], n, n
            own["rest"] = n - 1 - np.arange(len(first))
            waiting.append(own)
            part_of.append(part)
            size += len(first)
            if size > POSTINGS_PER_PART:
                yield from flush()
                waiting, part_of, size = [], [], 0
        if size:
            yield from flush()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = ((p, e) for b in batches for p, e in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        for part, group in groupby(stream, key=lambda r: r[0]):
            entries, homes = meeting_entries(combined(np.concatenate([np.frombuffer(e, ENTRY) for _, e in group])))
            if len(entries):
                token = (np.int64(part) << np.int64(32)) | entries["token"].astype(np.int64)
                home = pa.array(homes, pa.int64(), mask=homes == 0)
                yield pa.RecordBatch.from_arrays([pa.array(token), home, pa.array(entries["group"])], ["token", "home", "group"])

    dealt = owned.mapInArrow(deal, "part int, entries binary")
    together = dealt.repartition(parts, "part").sortWithinPartitions("part")
    return together.mapInArrow(meet, "token long, home long, group long")


def runs_of(token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each run of equal tokens."""
    begins = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]])) if len(token) else np.zeros(0, np.int64)
    return begins, np.append(begins[1:], len(token))[: len(begins)]


def meeting_entries(entries: np.ndarray, block: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """The entries that sizes and positions allow to link with another of their token, and the homes of these.

    Tokens of more than `SHORT` groups keep all their entries; pairs are only formed below that. Tokens of more
    than `FEW` groups have home 0. Entries of a token stand by least size, so only a stretch of entries can be large enough but not too large.
    """
    entries = entries[np.lexsort((entries["least"], entries["token"]))]
    begins, ends = runs_of(entries["token"])
    held = np.repeat(ends - begins > SHORT, ends - begins)
    some = (ends - begins > 1) & (ends - begins <= SHORT)
    starts = np.concatenate([np.zeros(0, np.int64), *(np.arange(i, j - 1) for i, j in zip(begins[some], ends[some], strict=True))]).astype(np.int64)
    stops = np.repeat(ends[some], (ends - begins)[some] - 1)
    least, most, rest = (entries[c].astype(np.int64) for c in ("least", "most", "rest"))
    done = 0
    while done < len(starts):
        total = np.cumsum(stops[done:] - starts[done:] - 1)
        take = max(1, int(np.searchsorted(total, block, "right")))
        i, stop = starts[done : done + take], stops[done : done + take]
        counts = stop - i - 1
        left = np.repeat(i, counts)
        right = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts) + left + 1
        # The right entry's sets are at least as large as the left one's smallest.
        fits = 5 * most[left] >= 4 * least[right]
        left, right = left[fits], right[fits]
        reach = 1 + np.minimum(rest[left], rest[right])
        able = 9 * reach >= 4 * (least[left] + least[right])
        held[left[able]] = held[right[able]] = True
        done += take
    entries = entries[held]
    begins, ends = runs_of(entries["token"])
    homes = np.zeros(len(entries), np.int64)
    for i, j in zip(begins.tolist(), ends.tolist(), strict=True):
        if j - i <= FEW:
            homes[i:j] = xxhash.xxh3_64_intdigest(np.sort(entries["group"][i:j]).tobytes()) >> 1 or 1
    return entries, homes


def homes_of(met: DataFrame) -> DataFrame:
    """`met` with homes for the shingles of many groups: the most frequent one that occurs with it in a group."""
    frequent = met.where("home IS NULL").select("token", "group")
    sizes = frequent.groupBy("token").agg(F.count("*").alias("size"))
    sized = frequent.join(sizes, "token")
    leaders = sized.groupBy("group").agg(F.max(F.struct("size", "token")).alias("leader"))
    homes = sized.join(leaders, "group").groupBy("token").agg((-1 - F.max("leader")["token"]).alias("home"))
    return met.where("home IS NOT NULL").select("token", "group", "home").union(frequent.join(homes, "token").select("token", "group", "home"))


def memberships(met: DataFrame, nodes: DataFrame, groups: DataFrame, texts: DataFrame, classes: object, parts: int) -> DataFrame:
    """home, node, group, n and size of text of every node that comes to a home.

    A node that is a group of its own comes with its group's shingles, a member of a larger group with those in its own prefix.
    """
    linked = groups.select("no", F.col("component").alias("group"))
    single = met.join(linked, met["group"] == linked["no"], "left_anti").select("home", F.col("group").alias("node"), "group")
    asked = met.join(linked.select("group").distinct(), "group", "left_semi")
    own = texts.join(linked.join(asked.select("group").distinct(), "group", "left_semi"), "no").select("no", "group", "text")

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, _, first in prefixes(batches, classes.value):
            part, token = prefix_tokens(first, parts)
            same = [pa.array(np.full(len(first), row[c], np.int64)) for c in ("no", "group")]
            yield pa.RecordBatch.from_arrays([pa.array((part << 32) | token.astype(np.int64)), *same], ["token", "node", "group"])

    held = own.mapInArrow(tokens, "token long, node long, group long").join(asked, ["token", "group"]).select("home", "node", "group")
    sized = nodes.select(F.col("no").alias("node"), "n", "bytes")
    return single.union(held).distinct().join(sized, "node")


def in_tiles(members: DataFrame) -> DataFrame:
    """`members` with the tile of each: the number of its first member. Members of a tile have about one size of
    text, and it holds at most `TILE_BYTES` of text or one member."""
    members = members.withColumn("kind", F.floor(F.log2(F.col("bytes") + 1)).cast("int"))
    numbered = number_rows(members, "place", order_by=["home", "kind", "group", "node"])
    rows = F.greatest(F.lit(1), F.least(F.lit(TILE_ROWS), F.floor(F.lit(TILE_BYTES) / F.pow(F.lit(2.0), F.col("kind") + 1)).cast("long")))
    own = Window.partitionBy("home", "kind", F.floor(F.col("place") / rows))
    return numbered.select("home", "node", "group", "n", F.min("place").over(own).alias("tile"))


class Tile:
    """Ordered sets of a tile's members, the trie they stand in, and their signatures."""

    def __init__(self, members: list[tuple[int, int, bytes]], hashes: sh.WordHashes, order: np.ndarray):
        self.nodes, self.groups = [m[0] for m in members], [m[1] for m in members]
        self.sets = [sh.in_order(s, order) for s in sh.shingle_sets([m[2] for m in members], hashes)]
        self.sizes = np.array([len(s) for s in self.sets], np.int64)
        self.trie = sh.Trie(self.sets)
        self.signed: dict[int, np.ndarray] = {}

    def signatures(self, bits: int) -> np.ndarray:
        if bits not in self.signed:
            self.signed[bits] = sh.parities(self.sets, bits)
        return self.signed[bits]


class Roots(dict):
    """Groups that links have joined, as far as this task knows."""

    def of(self, group: int) -> int:
        while group in self:
            if self[group] in self:
                self[group] = self[self[group]]
            group = self[group]
        return group

    def join(self, a: int, b: int) -> bool:
        a, b = self.of(a), self.of(b)
        if a != b:
            self[max(a, b)] = min(a, b)
        return a != b


def connecting_links(p: Tile, q: Tile, roots: Roots) -> Iterator[tuple[int, int]]:
    """Links between a set of `p` and one of `q` that connect two groups not connected so far."""
    bits = sh.signature_bits(int(max(p.sizes.max(), q.sizes.max())))
    differ = (bits - p.signatures(bits) @ q.signatures(bits).T) / 2
    able = 9 * differ <= p.sizes[:, None] + q.sizes
    for i in np.flatnonzero(able.any(1)).tolist():
        own = roots.of(p.groups[i])
        needed = [
            sh.least_overlap(int(p.sizes[i]), int(q.sizes[j])) if fits and roots.of(q.groups[j]) != own else sh.NEVER
            for j, fits in enumerate(able[i].tolist())
        ]
        if min(needed) == sh.NEVER:
            continue
        for j, overlap in enumerate(q.trie.overlaps(p.sets[i], needed)):
            if overlap >= 0 and roots.join(p.groups[i], q.groups[j]):
                yield p.nodes[i], q.nodes[j]


def able_work(work: DataFrame, nodes: DataFrame) -> DataFrame:
    """Of `work` (a, part, b, node, group), the rows whose signature leaves them a partner in another group.

    These are the members of a tile alone (part -1), the members of tile a that can link with any tile of the part
    (b is null), and those of each tile b that can link with tile a.
    """
    signed = work.join(nodes.select(F.col("no").alias("node"), "n", "signature"), "node")
    signed = signed.select("a", "part", "b", "node", "group", "n", "signature")
    signed = signed.repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for (a, part), unit in groupby(rows(batches), key=lambda r: r[:2]):
            probe, met = None, np.zeros(0, bool)
            for b, tile in groupby(unit, key=lambda r: r[2]):
                own = SignedTile(list(tile))
                if b is None:
                    probe, met = own, np.zeros(len(own.rows), bool)
                    if part >= 0:
                        continue
                able = probe.signed.able(own.signed) & (probe.groups[:, None] != own.groups)
                met |= able.any(1)
                if b is not None:
                    out += [own.rows[j][:5] for j in np.flatnonzero(able.any(0)).tolist()]
            out += [probe.rows[i][:5] for i in np.flatnonzero(met).tolist()]
            if len(out) > 10_000:
                yield batch_of(out)
                out = []
        if out:
            yield batch_of(out)

    def batch_of(kept: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*kept, strict=True)], ["a", "part", "b", "node", "group"])

    return signed.mapInArrow(keep, "a long, part long, b long, node long, group long")


class SignedTile:
    """Rows (a, part, b, node, group, n, signature) of a tile and their signatures."""

    def __init__(self, rows: list[tuple]):
        self.rows = rows
        self.groups = np.array([r[4] for r in rows], np.int64)
        self.signed = sh.Signed([r[5] for r in rows], [r[6] for r in rows])


def trie_links(members: DataFrame, nodes: DataFrame, texts: DataFrame, classes: object) -> DataFrame:
    """Links (a, b) that connect the groups that come together at a home.

    Work is dealt out by tile: alone, or as one tile with up to `TILES_PER_GROUP` others of its home. Texts are
    fetched from their buckets and shuffled once, to the work that needs them, for members that signatures leave there.
    """
    ends = [F.min("n").alias("least"), F.max("n").alias("most"), F.min("group").alias("first"), F.max("group").alias("last")]
    shapes = stage(members.groupBy("home", "tile").agg(*ends), "tiles")
    left, right = (shapes.select(*[F.col(c).alias(f"{c}_{side}" if c != "home" else c) for c in shapes.columns]) for side in "ab")
    fits = (5 * F.col("most_a") >= 4 * F.col("least_b")) & (5 * F.col("most_b") >= 4 * F.col("least_a"))
    apart = (F.col("first_a") != F.col("last_a")) | (F.col("first_b") != F.col("last_b")) | (F.col("first_a") != F.col("first_b"))
    pairs = left.join(right, "home").where((F.col("tile_a") < F.col("tile_b")) & fits & apart).select(F.col("tile_a").alias("a"), F.col("tile_b").alias("b"))
    # Tiles of one home are next to each other by number, so neighbours of a tile fall into one part.
    pairs = stage(pairs.withColumn("part", F.floor(F.col("b") / (TILE_ROWS * TILES_PER_GROUP))), "tile_pairs")
    nothing = F.lit(None).cast("long")
    held = lambda side: members.select(F.col("tile").alias(side), "node", "group")
    alone = shapes.where("first <> last").select(F.col("tile").alias("a")).join(held("a"), "a")
    alone = alone.select("a", F.lit(-1).cast("long").alias("part"), nothing.alias("b"), "node", "group")
    probes = pairs.select("a", "part").distinct().join(held("a"), "a").select("a", "part", nothing.alias("b"), "node", "group")
    others = pairs.join(held("b"), "b").select("a", "part", "b", "node", "group")
    work = able_work(alone.union(probes).union(others), nodes).join(texts.select(F.col("no").alias("node"), "text"), "node")
    work = work.select("a", "part", "b", "node", "group", "text")
    work = work.repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for piece in text_slices(batches, "text", TEXT_BYTES):
            columns = [piece.column(c).to_pylist() for c in ("a", "part", "b", "node", "group")]
            yield from zip(*columns, text_bytes(piece.column("text")), strict=True)

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, roots, probe = sh.WordHashes(), Roots(), None
        for (_, part, b), tile in groupby(rows(batches), key=lambda r: r[:3]):
            own = Tile([r[3:] for r in tile], hashes, classes.value)
            if b is None:
                probe = own
                if part >= 0:
                    continue
            found = list(connecting_links(probe, own, roots))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], ["a", "b"])

    return work.mapInArrow(link, "a long, b long")


def text_hashes(text: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes."""
    return F.xxhash64(text), F.xxhash64(F.lit(1), text)


def text_numbers(base: DataFrame) -> DataFrame:
    """`base` with `no`, a number for each distinct text: a 64-bit hash, or another one where two texts share that."""
    first, second = text_hashes(F.col("text"))
    both = base.where(F.col("text").isNotNull()).select(first.alias("h1"), second.alias("h2")).distinct()
    shared = stage(both.groupBy("h1").agg(F.min("h2").alias("least"), F.count("*").alias("n")).where("n > 1").select("h1", "least"), "shared_hashes")
    if shared.isEmpty():
        return base.withColumn("no", first)
    marked = base.withColumns({"h1": first, "h2": second}).join(broadcast_if_small(shared), "h1", "left")
    no = F.when(F.col("least").isNotNull() & (F.col("h2") != F.col("least")), F.xxhash64("h1", "h2")).otherwise(F.col("h1"))
    return marked.withColumn("no", no).drop("h1", "h2", "least")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (default: all) with n_shingles, component_id, text_id and group_id.

    Words are what ASCII white space parts, A-Z lower-cased; a document's set has its distinct 5-word
    shingles, or all words as one if there are fewer. Documents link if 100 * intersection >= 80 * union;
    component_id is the smallest doc_id reachable. Null and empty texts have no shingles and link with
    nothing, not even with each other: their component_id is their own id. A null id is never the smallest;
    a component of null ids only has a null component_id. Repeated rows are in one component. text_id tells
    equal texts and group_id components, whatever their ids; both are null without shingles. Derived columns
    replace input columns of those names. `docs` should be a scan: it is read several times.
    """
    spark: SparkSession = docs.sparkSession
    keep = docs.columns if keep is None else keep
    base = docs.select(
        F.struct(*(field(docs, c) for c in keep)).alias("row"),
        field(docs, doc_id).alias("id"),
        field(docs, text).cast("string").alias("text"),
    )
    base = text_numbers(base)
    rows = base.select("row", "id", "no", F.col("text").isNotNull().alias("known"))
    if text not in keep:
        rows = stage(rows, "shingle_rows")

    total = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = min(MOST_BUCKETS, max(width, math.ceil(total / BUCKET_BYTES)))
    one = Window.partitionBy("no").orderBy(F.col("id").asc_nulls_last())
    name, path = f"shingle_texts_{uuid.uuid4().hex}", new_path(spark, "shingle_texts")
    (
        base.where(F.col("text").isNotNull())
        .select("no", "id", "text")
        .withColumn("nth", F.row_number().over(one))
        .where("nth = 1")
        .drop("nth")
        .repartition(buckets, "no")
        .write.bucketBy(buckets, "no")
        .sortBy("no")
        .option("path", path)
        .saveAsTable(name)
    )
    try:
        texts = spark.table(name)
        slots = 1 << min(MOST_SLOTS.bit_length() - 1, max(12, (total // 6 // WORDS_PER_SLOT).bit_length()))
        signed = stage(sign_and_count(texts, slots), "signed")
        nodes = signed.where("n > 0").drop("slice", "counts")
        # At most MOST_SLOTS bytes.
        classes = spark.sparkContext.broadcast(frequency_classes(signed.where("slice is not null"), slots))
        links = band_links(nodes, texts, classes)
        groups = stage(components(links).select(F.col("node").alias("no"), "component"), "groups")
        size = F.col("n")
        postings = nodes.agg(F.sum(size - F.ceil(4 * size / 5) + 1)).first()[0] or 0
        parts = max(width, math.ceil(postings / POSTINGS_PER_PART))
        met = stage(meeting_groups(texts, groups, classes, int(parts)), "met")
        met = stage(homes_of(met), "homes")
        members = stage(memberships(met, nodes, groups, texts, classes, int(parts)), "members")
        more = stage(trie_links(stage(in_tiles(members), "in_tiles"), nodes, texts, classes), "trie_links")
        joined = components(links.select("a", "b").union(more))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        remove_path(spark, path)

    rooted = nodes.join(joined, F.col("no") == F.col("node"), "left").select("no", "id", "n", F.coalesce("component", "no").alias("root"))
    rooted = stage(rooted, "roots")
    smallest = rooted.groupBy("root").agg(F.min("id").alias("smallest"))
    named = rooted.join(smallest, "root").select(F.col("no").alias("node_no"), "n", "smallest", "root")
    derived = ["n_shingles", "component_id", "text_id", "group_id"]
    found = rows.join(named, F.col("known") & (F.col("no") == F.col("node_no")), "left")
    kept = [c for c in keep if c not in derived]
    return found.select(
        *(F.col("row").getField(c).alias(c) for c in kept),
        F.coalesce("n", F.lit(0).cast("long")).alias("n_shingles"),
        F.when(F.col("n").isNotNull(), F.col("smallest")).otherwise(F.col("id")).alias("component_id"),
        F.col("node_no").alias("text_id"),
        F.col("root").alias("group_id"),
    )


def op5_prefix_trie_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle set size and group of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    names = ["doc_id", "n_shingles", "component_id"]
    return written_result(spark, "op5", lambda: near_duplicates(docs, keep=["doc_id"]).select(*names))


def stage_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, also of groups whose ids are null or repeated: that with the smallest id, null
    last, and of several such the first by text and the other columns. Documents without words stay.

    Groups choose among rows without their texts; the chosen texts are then taken from `docs`, shuffled once.
    """
    others = ["lang", "source", "n_chars"]

    def first_texts() -> DataFrame:
        found = near_duplicates(docs, keep=[c for c in docs.columns if c != "text"])
        order = Window.partitionBy("group_id").orderBy(F.col("doc_id").asc_nulls_last(), "text_id", *others)
        return found.where("group_id is not null").withColumn("nth", F.row_number().over(order)).where("nth = 1").select("text_id")

    first = written_result(spark, "first_texts", first_texts)
    text = field(docs, "text").cast("string")
    worded = F.coalesce(text.rlike(WORD), F.lit(False))
    base = text_numbers(docs.select(F.struct(*(field(docs, c) for c in docs.columns)).alias("row"), text.alias("text")))
    of_text = Window.partitionBy("no").orderBy(F.col("row.doc_id").asc_nulls_last(), *(f"row.{c}" for c in others))
    one = base.where(F.col("text").rlike(WORD)).select("no", "row").withColumn("nth", F.row_number().over(of_text)).where("nth = 1")
    chosen = one.join(first, one["no"] == first["text_id"], "left_semi").select("row.*")
    return chosen.union(docs.where(~worded))


ORACLE_SQL = {
    "op5_prefix_trie_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + least(5, len(ws)) - 1], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 5, 0) + 2)) AS i FROM w WHERE len(ws) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), links AS (
  SELECT c.a, c.b
  FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL) c
  JOIN n p ON p.doc_id = c.a JOIN n q ON q.doc_id = c.b
  WHERE 100 * c.c >= 80 * (p.n + q.n - c.c)
), reach(doc_id, r) AS (
  SELECT doc_id, doc_id FROM w
  UNION
  SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.r
)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, min(r) AS component_id
FROM w JOIN reach USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY w.doc_id, n.n
"""
}
