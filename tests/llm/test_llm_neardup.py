import random

import numpy as np
import pytest

from stratiform.llm import neardup
from stratiform.llm import shingles as sh
from stratiform.llm.components import components
from stratiform.workspace import stage


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(docs):
    """n_shingles and component of every row, by all pairs."""
    sets = [shingle_set(t) for _, t in docs]
    parent = list(range(len(docs)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and min(len(sets[i]), len(sets[j])) * 5 >= max(len(sets[i]), len(sets[j])) * 4:
                both = len(sets[i] & sets[j])
                if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                    parent[find(i)] = find(j)
    smallest = {}
    for i, (d, _) in enumerate(docs):
        if sets[i] and d is not None:
            smallest[find(i)] = min(d, smallest.get(find(i), d))
    return [(d, len(sets[i]), smallest.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(docs)]


def compare(spark, docs):
    frame = spark.createDataFrame([(d, t, "clash") for d, t in docs], "doc_id long, text string, component_id string").repartition(3)
    rows = neardup.near_duplicates(frame, keep=["doc_id", "component_id"]).collect()
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted([(r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows], key=key) == sorted(brute(docs), key=key)


def test_edge_rows(spark):
    long = " ".join(map(str, range(30_000)))
    compare(
        spark,
        [(1, None), (2, ""), (3, " \n\t"), (4, "A b c"), (5, "a B\nc"), (5, "a b c"), (6, "a b"), (7, "a b c d e f"), (None, "a b c d e f"),
         (8, long), (9, long + " end"), (None, "alone and without any id here"), (10, "é b c"), (11, "É b c"), (12, "a b c")],
    )


@pytest.mark.parametrize("seed", [1, 2])
def test_families_of_edited_copies(spark, seed):
    """Chains and stars around the threshold, where most pairs of a family do not link directly."""
    source = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    docs, number = [], 0
    for _ in range(12):
        base = [source.choice(words) for _ in range(source.randint(8, 90))]
        for _ in range(source.randint(1, 14)):
            copy = list(base)
            for _ in range(source.randint(0, max(1, len(base) // 25))):
                copy[source.randrange(len(copy))] = source.choice(words)
            if source.random() < 0.3:
                base = copy
            docs.append((number, " ".join(copy)))
            number += 1
    source.shuffle(docs)
    compare(spark, docs)


def test_a_hub_whose_members_do_not_link(spark):
    """Copies of one text, each with its own edits: all link with the text, hardly any with each other."""
    source = random.Random(9)
    base = [f"b{i}" for i in range(104)]
    docs = []
    for k in range(60):
        copy = list(base)
        for at in source.sample(range(104), 3):
            copy[at] = f"own{k}_{at}"
        docs.append((k, " ".join(copy)))
    compare(spark, docs + [(1000, " ".join(base))])
    compare(spark, docs)


def test_links_that_bands_miss_are_found(spark, monkeypatch):
    """With bands that say next to nothing, the homes and their tries must find what is missing."""
    monkeypatch.setattr(neardup.sh, "band_keys", lambda sets: np.array([[len(s) % 3] * sh.BANDS for s in sets], np.int64).reshape(len(sets), sh.BANDS))
    source = random.Random(5)
    base = [f"b{i}" for i in range(60)]
    docs = []
    for k in range(40):
        copy = list(base)
        for at in source.sample(range(60), source.randint(0, 2)):
            copy[at] = f"x{source.randint(0, 3)}"
        docs.append((k, " ".join(copy[: source.randint(56, 60)])))
    compare(spark, docs)


@pytest.mark.parametrize("few, short, rows", [(4, 64, 256), (1, 2, 3), (0, 1, 1)])
def test_homes_and_tiles_of_any_size_lose_no_link(spark, monkeypatch, few, short, rows):
    """Near copies of one text, most of them not linked with each other, in homes of many tiles."""
    monkeypatch.setattr(neardup, "FEW", few)
    monkeypatch.setattr(neardup, "SHORT", short)
    monkeypatch.setattr(neardup, "TILE_ROWS", rows)
    monkeypatch.setattr(neardup, "TILES_PER_GROUP", 2)
    monkeypatch.setattr(neardup.sh, "band_keys", lambda sets: np.arange(len(sets) * sh.BANDS, dtype=np.int64).reshape(len(sets), sh.BANDS))
    source = random.Random(few)
    base = [f"b{i}" for i in range(80)]
    docs = []
    for k in range(70):
        copy = list(base)
        for at in source.sample(range(80), source.randint(0, 5)):
            copy[at] = f"x{source.randint(0, 5)}"
        docs.append((k, " ".join(copy[: source.randint(40, 80)])))
    compare(spark, docs)


def test_signatures_bound_the_difference():
    source = random.Random(4)
    for _ in range(200):
        both = source.sample(range(10**9), source.randint(1, 400))
        a, b = (np.array(sorted(set(both) | set(source.sample(range(10**9), source.randint(0, 300)))), np.uint64) for _ in range(2))
        bits = sh.signature_bits(max(len(a), len(b)))
        p, q = sh.parities([a, b], bits)
        assert (bits - p @ q) / 2 <= len(np.setxor1d(a, b))


def test_packed_signatures_never_part_sets_that_link():
    """Sets of any size, also of signatures of different widths: what `able` rules out does not link."""
    source = random.Random(6)
    sets = [np.zeros(0, np.uint64)]
    for size in [1, 2, 9, 60, 63, 64, 127, 128, 250, 256, 400, 2000, 5000]:
        base = source.sample(range(10**12), size)
        for _ in range(6):
            changed = source.sample(range(10**12), source.randint(0, size // 4))
            sets.append(np.array(sorted({*base[len(changed) * source.randint(0, 1) :], *changed}), np.uint64))
    order = list(range(len(sets)))
    source.shuffle(order)
    p, q = (sh.Signed([len(sets[i]) for i in part], sh.packed_signatures([sets[i] for i in part])) for part in (order[::2], order[1::2]))
    able, linked = p.able(q), 0
    for x, i in enumerate(order[::2]):
        for y, j in enumerate(order[1::2]):
            both = len(np.intersect1d(sets[i], sets[j]))
            if both and both >= sh.least_overlap(len(sets[i]), len(sets[j])):
                linked += 1
                assert able[x, y]
    assert linked >= 40 and able.sum() < 4 * linked


def test_texts_go_only_to_members_that_signatures_leave_a_partner(spark):
    """Strangers that meet at a home come without their texts, however many meet; near copies come with them."""
    source = random.Random(3)
    common, base = [f"c{i}" for i in range(8)], [f"b{i}" for i in range(90)]
    texts = [" ".join(common + [f"w{source.randint(0, 10**6)}" for _ in range(90)]) for _ in range(40)]
    texts += [" ".join([*base[:89], f"end{k}"]) for k in range(2)]
    sets = sh.shingle_sets([t.encode() for t in texts], sh.WordHashes())
    rows = [(i, len(s), bytearray(p)) for i, (s, p) in enumerate(zip(sets, sh.packed_signatures(sets), strict=True))]
    nodes = spark.createDataFrame(rows, "no long, n long, signature binary")
    alone = [(0, -1, None, i, i) for i in range(42)]
    paired = [(100, 0, None, i, i) for i in range(0, 42, 2)] + [(100, 0, 101 + i % 4, i, i) for i in range(1, 42, 2)]
    same_group = [(200, -1, None, i, 40) for i in (40, 41)]
    work = spark.createDataFrame(alone + paired + same_group, "a long, part long, b long, node long, group long")
    kept = sorted((tuple(r) for r in neardup.able_work(work, nodes).collect()), key=repr)
    assert kept == sorted([(0, -1, None, 40, 40), (0, -1, None, 41, 41), (100, 0, None, 40, 40), (100, 0, 102, 41, 41)], key=repr)


def test_the_stage_shuffles_texts_once(spark):
    """Choosing one document of each group moves ids; only the chosen texts' own shuffle holds the text."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    base = [f"b{i}" for i in range(30)]
    rows = [(k, " ".join([*base, f"end{k % 5}"]), "en", "s", 1) for k in range(20)] + [(50, None, "en", "s", 0), (51, " \t\n", "en", "s", 3), (51, " \t\n", "en", "s", 3)]
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        kept = neardup.stage_near_duplicates(spark, stage(spark.createDataFrame(rows, schema)), "")
        plan = kept._jdf.queryExecution().executedPlan()
        todo, exchanges = [plan], []
        while todo:
            node = todo.pop()
            if node.nodeName() == "Exchange":
                exchanges.append([a for a in (node.output().apply(i).dataType().simpleString() for i in range(node.output().size())) if "string" in a])
            children = node.children()
            todo += [children.apply(i) for i in range(children.size())]
        assert sum(any("text" in c or c == "string" for c in e) for e in exchanges) == 1
        assert sorted(r["doc_id"] for r in kept.collect()) == [0, 50, 51, 51]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_counting_costs_the_same_at_every_size():
    """The counter table has a largest size, so that its tasks' work and output follow the text."""
    assert neardup.MOST_SLOTS * 4 <= 4 << 20


def test_texts_that_share_a_hash_stay_apart(spark, monkeypatch):
    plain = neardup.text_hashes
    monkeypatch.setattr(neardup, "text_hashes", lambda text: (neardup.F.pmod(plain(text)[0], neardup.F.lit(3)), plain(text)[1]))
    compare(spark, [(i, f"text number {i // 2} of some few words") for i in range(20)] + [(100, None), (101, "")])


def test_one_of_each_group_stays_whatever_the_ids(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    base = [f"b{i}" for i in range(60)]
    near = [" ".join([*base[:59], f"end{k}"]) for k in range(5)]
    other = [" ".join([*reversed(base[1:]), f"end{k}"]) for k in range(5)]
    rows = [(None, t, "en", "s", 1) for t in near] + [(7, t, "en", "s", 1) for t in other] + [(7, other[0], "en", "s", 1)]
    kept = neardup.stage_near_duplicates(spark, spark.createDataFrame(rows, schema), "").collect()
    assert sorted((r["doc_id"] or 0, r["text"] in near) for r in kept) == [(0, True), (7, False)]


def test_trie_walk_counts_exactly():
    source = random.Random(2)
    for _ in range(100):
        probe = np.array(sorted(source.sample(range(5000), source.randint(1, 300))), np.uint64)
        sets = []
        for _ in range(10):
            own = set(probe.tolist()) - set(source.sample(probe.tolist(), min(len(probe) - 1, source.randint(0, 40))))
            sets.append(np.array(sorted(own | set(source.sample(range(5000), source.randint(0, 40)))), np.uint64))
        needed = [sh.least_overlap(len(probe), len(s)) for s in sets]
        for got, s, need in zip(sh.Trie(sets).overlaps(probe, needed), sets, needed, strict=True):
            both = len(np.intersect1d(probe, s))
            assert got == (both if both >= need else -1)
            assert (both >= need) == (100 * both >= 80 * (len(probe) + len(s) - both))


def test_components(spark):
    source = random.Random(3)
    edges = [(source.randint(0, 60), source.randint(0, 60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 160)] + [(7, 7)]
    parent = {}

    def find(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        if a != b:
            parent[max(find(a), find(b))] = min(find(a), find(b))
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: find(i) for i in list(parent)}


def test_empty_table_and_one_kept_per_group(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    empty = spark.createDataFrame([], schema)
    assert neardup.near_duplicates(empty).count() == 0
    rows = [(3, "a b c d e f", "en", "s", 1), (2, "a b c d e f", "en", "s", 1), (2, "a b c d e f", "en", "s", 1), (4, "", "en", "s", 0),
            (5, "", "en", "s", 0), (None, "q r s t u v", "en", "s", 1), (6, None, "en", "s", None)]
    kept = neardup.stage_near_duplicates(spark, spark.createDataFrame(rows, schema), "")
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept.where("text is not null").collect()) == [
        (0, "q r s t u v"), (2, "a b c d e f"), (4, ""), (5, "")]
    assert kept.where("text is null").count() == 1
