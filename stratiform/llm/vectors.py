"""Near duplicates of embeddings by PCA-ordered tiled comparison: which vectors of a label link, and the groups.

1. Equal vectors of a label become one class. Any number of copies is one row from here on.
2. Principal directions are fitted on a bounded sample of the classes. They are orthonormal, so any of them
   give right results; good ones put most of a product into the leading dimensions.
3. Classes are ordered by label, size and the cells of their leading coordinates, and cut into tiles. Two tiles
   meet if they share label and size and the gaps between their boxes of leading coordinates leave room for
   the threshold.
4. A pair of tiles is compared by steps of leading dimensions. After each step the partial products and the
   norms of what is left bound every cosine, and rows and columns without a pair in reach drop out. What
   is left is compared in full; cosines next to the threshold are computed once more from the given vectors.
5. A pair of tiles hands on link counts per class and one forest of its links, never the links. Components of
   the forests, by star steps in Spark, are those of the links.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.llm.common import field, set_aside, set_back, table, written_result
from stratiform.llm.components import components
from stratiform.operators.numbering import number_rows
from stratiform.workspace import stage

SIMILAR = 0.93
#: Leading dimensions after which a pair of tiles is bounded.
STEPS = (8, 16, 32, 64)
BOXED = 8
CELLS = 3
SAMPLE_ROWS = 1 << 12
SAMPLE_BYTES = 32 << 20
TILE_ROWS = 1 << 10
TILE_BYTES = 4 << 20
TILES_PER_GROUP = 8
#: How near to the threshold a cosine is computed again; rounding is far below.
NEAR = 1e-9

DERIVED = ["n_links", "component_id", "kept"]


def signed_vectors(rows: DataFrame, single: bool) -> DataFrame:
    """`rows` (row, id, label, vector) with the vector as bytes and a 128-bit digest of label and vector.

    Both are null where the label is null or the vector is null, empty, zero, or holds null or non-finite components.
    """
    kind = np.dtype("<f4" if single else "<f8")
    schema = T.StructType([rows.schema["row"], rows.schema["id"], rows.schema["label"], *T.StructType.fromDDL("digest binary, vector binary").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vector")
            # Null components become NaN. Adding zero makes a negative zero positive.
            values = pc.list_flatten(lists).to_numpy(zero_copy_only=False).astype(kind) + kind.type(0)
            size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            ends = np.cumsum(size)
            odd, filled = (np.concatenate([[0], np.cumsum(x)]) for x in (~np.isfinite(values), values != 0))
            good = (odd[ends] == odd[ends - size]) & (filled[ends] > filled[ends - size])
            raw, width = values.tobytes(), kind.itemsize
            vectors, digests = [], []
            for label, ok, end, n in zip(batch.column("label").to_pylist(), good.tolist(), ends.tolist(), size.tolist(), strict=True):
                vector = raw[(end - n) * width : end * width] if ok and label is not None else None
                vectors.append(vector)
                digests.append(None if vector is None else hashlib.blake2b(vector, digest_size=16, key=hashlib.blake2b(label.encode()).digest()).digest())
            kept = [batch.column(c) for c in ("row", "id", "label")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(digests, pa.binary()), pa.array(vectors, pa.binary())], ["row", "id", "label", "digest", "vector"])

    return rows.mapInArrow(run, schema)


class Space:
    """Unit vectors seen from principal directions."""

    def __init__(self, single: bool, bases: dict[int, np.ndarray]):
        self.kind = np.dtype("<f4" if single else "<f8")
        self.bases = bases

    def given(self, vectors: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(vectors), self.kind).reshape(len(vectors), -1).astype(np.float64)

    def unit(self, given: np.ndarray) -> np.ndarray:
        scaled = given / np.abs(given).max(1, keepdims=True)
        return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))

    def leading(self, unit: np.ndarray) -> np.ndarray:
        """The leading coordinates; of sizes that the sample lacks, the first ones as they are."""
        size = unit.shape[1]
        return unit @ self.bases[size] if size in self.bases else unit[:, : STEPS[-1]]


def fitted(classes: DataFrame, single: bool) -> Space:
    """Principal directions by vector size, from the classes with the smallest digests: some 4 096, at most 32 MiB."""
    widest = classes.agg(F.max(F.octet_length("vector"))).first()[0] or 1
    rows = max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // widest))
    by_size: dict[int, list[bytes]] = {}
    for r in classes.orderBy("digest").limit(rows).select("vector").collect():
        by_size.setdefault(len(r["vector"]), []).append(bytes(r["vector"]))
    space = Space(single, {})
    for width, vectors in by_size.items():
        unit = space.unit(space.given(vectors))
        size = width // space.kind.itemsize
        if len(unit) >= size:
            _, directions = np.linalg.eigh(unit.T @ unit)
            space.bases[size] = np.ascontiguousarray(directions[:, ::-1][:, : STEPS[-1]])
    return space


def placed(classes: DataFrame, space: object, reach: float) -> DataFrame:
    """`classes` with the size of the vector and the cells of its first leading coordinates."""
    cells = [f"cell{i}" for i in range(CELLS)]
    added = T.StructType.fromDDL(", ".join(f"{c} int" for c in ["size", *cells]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vector").to_pylist()
            width = np.array([len(v) for v in vectors], np.int64)
            size = width // space.value.kind.itemsize
            out = np.zeros((len(vectors), CELLS), np.int32)
            for n in np.unique(width).tolist():
                rows = np.flatnonzero(width == n)
                lead = space.value.leading(space.value.unit(space.value.given([vectors[i] for i in rows])))[:, :CELLS]
                out[rows, : lead.shape[1]] = np.floor(lead / reach)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(size.astype(np.int32)), *map(pa.array, out.T.copy())], [*batch.schema.names, *added.names])

    return classes.mapInArrow(run, T.StructType([*classes.schema.fields, *added.fields]))


def tiles_of(numbered: DataFrame, space: object, rows: int) -> DataFrame:
    """Tiles of at most `rows` classes of one label and size: number, classes as bytes, box of leading coordinates."""
    whole = numbered.groupBy(F.floor((F.col("no") - 1) / rows).alias("stretch"), "label", "size").agg(
        F.min("no").alias("tile"), F.collect_list(F.struct("no", "copies", "vector")).alias("classes")
    )
    schema = T.StructType([numbered.schema["label"], *T.StructType.fromDDL("size int, tile long, nos binary, copies binary, vectors binary, low array<double>, high array<double>").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                held = batch.column("classes")[i].values
                nos, copies = (held.field(c).to_numpy().astype(np.int64) for c in ("no", "copies"))
                vectors = held.field("vector").to_pylist()
                lead = space.value.leading(space.value.unit(space.value.given(vectors)))[:, :BOXED]
                low, high = np.zeros(BOXED), np.zeros(BOXED)
                low[: lead.shape[1]], high[: lead.shape[1]] = lead.min(0), lead.max(0)
                row = [batch.column("label")[i].as_py(), batch.column("size")[i].as_py(), batch.column("tile")[i].as_py()]
                row += [nos.tobytes(), copies.tobytes(), b"".join(vectors), low.tolist(), high.tolist()]
                kinds = [pa.string(), pa.int32(), pa.int64(), *[pa.binary()] * 3, *[pa.list_(pa.float64())] * 2]
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], schema.names)

    return whole.select("label", "size", "tile", "classes").mapInArrow(run, schema)


def tile_pairs(tiles: DataFrame, similar: float) -> DataFrame:
    """Pairs a <= b of tiles whose boxes leave room for a cosine of `similar`."""
    side = lambda s: tiles.select("label", "size", F.col("tile").alias(s), F.col("low").alias(f"low_{s}"), F.col("high").alias(f"high_{s}"))
    gaps = [F.greatest(F.lit(0.0), F.col("low_a")[i] - F.col("high_b")[i], F.col("low_b")[i] - F.col("high_a")[i]) for i in range(BOXED)]
    # Unit vectors with that cosine are sqrt(2 - 2 cos) apart at most, and so are their leading coordinates.
    room = sum((g * g for g in gaps), F.lit(0.0)) <= 2 - 2 * similar + NEAR
    return side("a").join(side("b"), ["label", "size"]).where((F.col("a") <= F.col("b")) & room).select("a", "b")


class Tile:
    """The classes of a tile, with leading coordinates and the norms of what follows each step."""

    def __init__(self, space: Space, nos: bytes, copies: bytes, vectors: bytes):
        self.nos, self.copies = np.frombuffer(nos, np.int64), np.frombuffer(copies, np.int64)
        self.given = np.frombuffer(vectors, space.kind).reshape(len(self.nos), -1).astype(np.float64)
        self.unit = space.unit(self.given)
        self.lead = space.leading(self.unit)
        self.steps = [k for k in STEPS if k < self.lead.shape[1]] + [self.lead.shape[1]]
        self.rest = {k: np.sqrt(np.maximum(0, 1 - (self.lead[:, :k] ** 2).sum(1))) for k in self.steps}


def linked_pairs(p: Tile, q: Tile, similar: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of `p` and of `q` whose cosine is at least `similar`."""
    rows, columns = np.arange(len(p.nos)), np.arange(len(q.nos))
    product = np.zeros((len(rows), len(columns)))
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for before, k in pairwise([0, *p.steps]):
        product += p.lead[rows, before:k] @ q.lead[columns, before:k].T
        able = product + p.rest[k][rows][:, None] * q.rest[k][columns] >= similar - NEAR
        up, across = able.any(1), able.any(0)
        if not up.any():
            return none
        if up.sum() * across.sum() < 0.5 * able.size:
            product, able = product[np.ix_(up, across)], able[np.ix_(up, across)]
            rows, columns = rows[up], columns[across]
    i, j = np.nonzero(able)
    if p.steps[-1] == p.unit.shape[1]:
        cosine = product[i, j]
    elif len(i) * 8 > able.size:
        cosine = (p.unit[rows] @ q.unit[columns].T)[i, j]
    else:
        cosine = np.concatenate([np.einsum("ij,ij->i", p.unit[rows[i[s : s + 4096]]], q.unit[columns[j[s : s + 4096]]]) for s in range(0, len(i), 4096)])
    i, j = rows[i], columns[j]
    for n in np.flatnonzero(np.abs(cosine - similar) < NEAR).tolist():
        x, y = p.given[i[n]], q.given[j[n]]
        x, y = x / np.abs(x).max(), y / np.abs(y).max()
        cosine[n] = x.dot(y) / math.sqrt(x.dot(x) * y.dot(y))
    held = cosine >= similar
    return i[held], j[held]


def forest(a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """For each of `size` nodes the smallest one that the pairs connect it with."""
    smallest = np.arange(size)
    while True:
        least = np.minimum(smallest[a], smallest[b])
        if (smallest[a] == least).all() and (smallest[b] == least).all():
            return smallest
        np.minimum.at(smallest, a, least)
        np.minimum.at(smallest, b, least)
        smallest = smallest[smallest]


def compared(pairs: DataFrame, tiles: DataFrame, space: object, similar: float, rows: int) -> DataFrame:
    """Rows of two kinds. Counts: class a, and n vectors of other classes that it links with. Edges: classes a and b."""
    dealt = pairs.withColumn("part", F.floor(F.col("b") / (rows * TILES_PER_GROUP)))
    held = ["nos", "copies", "vectors"]
    of = lambda side: tiles.select(F.col("tile").alias(side), *held)
    probes = dealt.select("a", "part").distinct().join(of("a"), "a").select("a", "part", F.lit(None).cast("long").alias("b"), *held)
    others = dealt.join(of("b"), "b").select("a", "part", "b", *held)
    grouped = probes.union(others).repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probe = None
        for batch in batches:
            for i in range(batch.num_rows):
                a, b = (batch.column(c)[i].as_py() for c in ("a", "b"))
                if b is None:
                    probe = Tile(space.value, *(batch.column(c)[i].as_py() for c in held))
                    continue
                same = a == b
                other = probe if same else Tile(space.value, *(batch.column(c)[i].as_py() for c in held))
                yield from found(probe, other, same)

    def found(p: Tile, q: Tile, same: bool) -> Iterator[pa.RecordBatch]:
        i, j = linked_pairs(p, q, similar)
        if same:
            i, j = i[i != j], j[i != j]
        if not len(i):
            return
        counts = np.bincount(i, q.copies[j], len(p.nos))
        nos = p.nos
        if not same:
            nos = np.concatenate([p.nos, q.nos])
            counts = np.concatenate([counts, np.bincount(j, p.copies[i], len(q.nos))])
            j = j + len(p.nos)
        root = forest(i, j, len(nos))
        linked, apart = np.flatnonzero(counts), np.flatnonzero(root != np.arange(len(nos)))
        a = pa.array(np.concatenate([nos[linked], nos[apart]]))
        b = pa.array([None] * len(linked) + nos[root[apart]].tolist(), pa.int64())
        n = pa.array(counts[linked].astype(np.int64).tolist() + [None] * len(apart), pa.int64())
        yield pa.RecordBatch.from_arrays([a, b, n], ["a", "b", "n"])

    return grouped.mapInArrow(run, "a long, b long, n long")


def near_vectors(
    vectors: DataFrame,
    vector: str = "embedding",
    label: str = "label",
    vec_id: str = "vec_id",
    keep: list[str] | None = None,
    similar: float = SIMILAR,
) -> DataFrame:
    """The columns `keep` (default: all) with n_links, component_id and kept.

    Vectors of one label link if their cosine is at least `similar`, in double precision; vectors of different size
    never do. n_links counts the other rows linked directly, component_id is the smallest id reachable, and
    kept says whether it is the row's own. A row links with nothing if its label is null, or its vector is null,
    empty, zero, or holds a null or non-finite component: its component_id is its own id. Repeated rows link
    with each other, and rows repeated under one id are all kept or none. A null id is never the smallest; a component of null ids only
    has a null component_id and is kept. Derived columns replace input columns of those names.
    """
    keep = vectors.columns if keep is None else keep
    given = field(vectors, vector)
    single = isinstance(vectors.schema[vector].dataType.elementType, T.FloatType)
    rows = vectors.select(
        F.struct(*set_aside(vectors, keep)).alias("row"),
        field(vectors, vec_id).alias("id"),
        field(vectors, label).cast("string").alias("label"),
        given.cast("array<float>" if single else "array<double>").alias("vector"),
    )
    rows = stage(signed_vectors(rows, single), "signed_vectors")
    classes = rows.where("digest is not null").groupBy("digest").agg(
        F.first("label").alias("label"), F.first("vector").alias("vector"), F.count("*").alias("copies"), F.min("id").alias("least_id")
    )
    classes = stage(classes, "vector_classes")
    fit = fitted(classes, single)
    space = vectors.sparkSession.sparkContext.broadcast(fit)
    widest = classes.agg(F.max(F.octet_length("vector"))).first()[0] or 1
    tile_rows = max(1, min(TILE_ROWS, TILE_BYTES // widest))
    order = ["label", "size", *(f"cell{i}" for i in range(CELLS)), "digest"]
    reach = math.sqrt(2 - 2 * similar) + NEAR
    numbered = stage(number_rows(placed(classes, space, reach), "no", order_by=order).drop("cell0", "cell1", "cell2"), "numbered_classes")
    tiles = stage(tiles_of(numbered, space, tile_rows), "tiles")
    found = stage(compared(tile_pairs(tiles, similar), tiles, space, similar, tile_rows), "tile_links")

    links = found.where("n is not null").groupBy(F.col("a").alias("no")).agg(F.sum("n").alias("n"))
    joined = stage(components(found.where("b is not null").select("a", "b")).withColumnRenamed("node", "no"), "vector_groups")
    own = numbered.select("no", "digest", "copies", "least_id").join(links, "no", "left").join(joined, "no", "left")
    own = own.select("digest", "copies", "least_id", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("component", "no").alias("root"))
    smallest = own.groupBy("root").agg(F.min("least_id").alias("smallest"))
    named = own.join(smallest, "root").select(F.col("digest").alias("class"), (F.col("n") + F.col("copies") - 1).alias("n"), "smallest")
    back = rows.join(named, F.col("digest") == F.col("class"), "left").select("row.*", "id", "n", "smallest", "class")
    component = F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("smallest"))
    return back.select(
        *set_back(keep, DERIVED),
        F.coalesce("n", F.lit(0).cast("long")).alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def op13_pca_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and group of every embedding."""
    vectors = table(spark, sf_dir, "embeddings")
    return written_result(spark, "op13", lambda: near_vectors(vectors, keep=["vec_id"]).select("vec_id", *DERIVED))


ORACLE_SQL = {
    "op13_pca_tiles": """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e, sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS length
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE a.length > 0 AND b.length > 0 AND len(a.e) = len(b.e) AND list_dot_product(a.e, b.e) / (a.length * b.length) >= 0.93
), reach(vec_id, r) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION
  SELECT reach.vec_id, links.b FROM reach JOIN links ON links.a = reach.r
), n AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT vec_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_links, min(r) AS component_id, vec_id = min(r) AS kept
FROM reach LEFT JOIN n ON n.a = vec_id GROUP BY vec_id
"""
}
