"""Near duplicates of embeddings against all cosines."""

import math

import numpy as np
import pytest

from stratiform.llm import vectors
from stratiform.llm.vectors import DERIVED, near_vectors


def expected(data, similar=0.93):
    """n_links, component_id and kept of (id, vector, label) rows, from every pair."""
    good = []
    for i, (_, v, label) in enumerate(data):
        ok = label is not None and v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
        good.append(np.array(v, float) if ok else None)
    links = [set() for _ in data]
    for i, x in enumerate(good):
        for j in range(i):
            y = good[j]
            if x is None or y is None or data[i][2] != data[j][2] or len(x) != len(y):
                continue
            u, w = x / np.abs(x).max(), y / np.abs(y).max()
            if (u @ w) / math.sqrt((u @ u) * (w @ w)) >= similar:
                links[i].add(j)
                links[j].add(i)
    out = []
    for i, (own, _, _) in enumerate(data):
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        ids = [data[j][0] for j in seen if data[j][0] is not None]
        least = min(ids) if ids else None
        out.append((len(links[i]), least, own == least))
    return out


def check(spark, data, kind="float", **more):
    df = spark.createDataFrame([(*row, i) for i, row in enumerate(data)], f"vec_id long, embedding array<{kind}>, label int, place int").repartition(4)
    found = {r["place"]: tuple(r[c] for c in DERIVED) for r in near_vectors(df, keep=["place"], **more).collect()}
    assert [found[i] for i in range(len(data))] == expected(data, **more)


def clustered(rng, n, size, spread=0.25):
    centres = rng.normal(size=(n // 8 + 1, size))
    return centres[rng.integers(0, len(centres), n)] + spread * rng.normal(size=(n, size))


@pytest.mark.parametrize("size, tile", [(64, 1024), (64, 16), (5, 7), (200, 32), (1, 4)])
def test_links_and_groups_equal_all_pairs(spark, monkeypatch, size, tile):
    monkeypatch.setattr(vectors, "TILE_ROWS", tile)
    rng = np.random.default_rng(size + tile)
    rows = clustered(rng, 300, size).astype(np.float32).tolist()
    rows += [rows[3]] * 40 + [[2 * x for x in rows[4]]] * 3
    labels = rng.integers(0, 3, len(rows)).tolist()
    check(spark, [(1000 - i, v, label) for i, (v, label) in enumerate(zip(rows, labels))])


def test_odd_vectors_link_with_nothing(spark):
    one, nan, inf = [1.0, 2.0, 3.0], float("nan"), float("inf")
    odd = [None, [], [0.0, 0.0, 0.0], [-0.0, 0.0, 0.0], [1.0, None, 3.0], [nan, 1.0, 1.0], [inf, 1.0, 1.0]]
    data = [(i, v, 1) for i, v in enumerate([*odd, *odd])] + [(50, one, None), (51, one, None), (52, one, 1), (53, one, 1), (54, one, 2)]
    data += [(55, [1.0, 2.0], 1), (56, [1.0, 2.0, 3.0, 0.0], 1), (None, one, 1), (None, [9.0, -9.0, 1.0], 2), (53, one, 1)]
    check(spark, data)


def test_extreme_doubles_and_the_threshold_itself(spark):
    tiny, huge = [1e-300, 2e-300], [1e300, 2e300]
    angle = math.acos(0.93)
    near = [[math.cos(a), math.sin(a)] for a in (0.0, angle, angle * (1 + 1e-12), angle * (1 - 1e-12), 2 * angle, 3 * angle)]
    check(spark, [(i, v, 1) for i, v in enumerate([tiny, huge])] + [(10 + i, v, 2) for i, v in enumerate(near)], "double")


def test_a_chain_is_one_group(spark, monkeypatch):
    monkeypatch.setattr(vectors, "TILE_ROWS", 8)
    step = math.acos(0.93) * 0.9
    check(spark, [(200 - i, [math.cos(i * step / 20), math.sin(i * step / 20), 0.0], 7) for i in range(90)], "double")


def test_tiles_out_of_reach_never_meet(spark):
    rng = np.random.default_rng(1)
    east, west = (np.array([s, 0, 0, 0, 0, 0, 0, 0]) + 0.01 * rng.normal(size=(64, 8)) for s in (1, -1))
    df = spark.createDataFrame([(i, v, 1) for i, v in enumerate(np.concatenate([east, west]).tolist())], "vec_id long, embedding array<double>, label int")
    pairs = []
    plain = vectors.tile_pairs

    def watched(tiles, similar):
        found = plain(tiles, similar)
        pairs.append((tiles.count(), found.count()))
        return found

    vectors.tile_pairs = watched
    try:
        vectors.TILE_ROWS, before = 64, vectors.TILE_ROWS
        assert near_vectors(df).select("component_id").distinct().count() == 2
    finally:
        vectors.tile_pairs, vectors.TILE_ROWS = plain, before
    assert pairs == [(2, 2)]


def test_extra_and_clashing_columns_and_empty_tables(spark):
    schema = "vec_id long, embedding array<float>, label string, n_links string, digest int, `a.b` int"
    df = spark.createDataFrame([(1, [1.0], "x", "q", 1, 2), (2, [2.0], "x", "q", 1, 3)], schema)
    found = near_vectors(df)
    assert found.columns == ["vec_id", "embedding", "label", "digest", "a.b", *DERIVED]
    assert sorted((r["vec_id"], r["a.b"], r["n_links"], r["component_id"], r["kept"]) for r in found.collect()) == [(1, 2, 1, 1, True), (2, 3, 1, 1, False)]
    assert near_vectors(spark.createDataFrame([], schema)).count() == 0
