import re

import numpy as np
import pytest

from stratiform.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(FOLD))


def brute(text, items, window):
    own, hit, ids = words(text), set(), set()
    for name, body in items:
        b = words(body)
        k = min(window, len(b))
        wanted = {tuple(b[i : i + k]) for i in range(len(b) - k + 1)} if b else set()
        for i in range(len(own) - k + 1 if k else 0):
            if tuple(own[i : i + k]) in wanted:
                hit.update(range(i, i + k))
                ids.add("null" if name is None else str(name))
    return len(own), len(hit), sorted(ids)


def answer(spark, docs, items, **options):
    documents = spark.createDataFrame(docs, "doc_id long, text string, n_words string")
    found = dc.find_passages(documents, spark.createDataFrame(items, "item_id long, text string"), **options)
    return found.select("doc_id", "n_words", dc.n_hit(), "hit_items", "hit_spans").collect()


ITEMS = [(1, "a b c d e"), (2, "c d e f"), (3, "x"), (4, ""), (5, None), (None, "q r s"), (1, "Ünï cödé")]
DOCS = [
    (1, "A b, C d e f!", "clash"),
    (2, "a b c d", None),
    (3, None, None),
    (4, "", None),
    (5, "x y x", None),
    (6, "ünï CÖDÉ ünï cödé q R s", None),
    (6, "ünï CÖDÉ ünï cödé q R s", None),
    (None, "c d e f c d e f", None),
    (8, "a b c d e f " * 5000, None),
    (9, "..., !!", None),
]


@pytest.mark.parametrize("options", [{}, {"block_bytes": 4}, {"shard_words": 8}])
def test_matches_brute_force(spark, options):
    got = answer(spark, DOCS, ITEMS, window=4, **options)
    assert len(got) == len(DOCS)
    want = sorted((d, *brute(t, ITEMS, 4)) for d, t, _ in DOCS if d is not None)
    assert sorted((r[0], r[1], r[2], r[3]) for r in got if r[0] is not None) == want
    assert [(r[1], r[2], r[3]) for r in got if r[0] is None] == [brute("c d e f c d e f", ITEMS, 4)]


def test_random_shards_match_brute_force():
    random = np.random.default_rng(3)
    for _ in range(30):
        texts = [" ".join(random.choice(list("abcd"), random.integers(0, 60))) for _ in range(8)]
        items = [(i, " ".join(random.choice(list("abcz"), random.integers(0, 9)))) for i in range(6)]
        wanted = dc.passages([(str(i), t) for i, t in items], 5)
        spans, ids = dc.search_shard([t.encode().split() for t in texts], wanted)
        for text, own, names in zip(texts, spans, ids, strict=True):
            assert (len(text.split()), sum(b - a for a, b in own), sorted(names)) == brute(text, items, 5)
            assert all(a[1] < b[0] for a, b in zip(own, own[1:]))


def test_suffix_order():
    random = np.random.default_rng(5)
    for n in (1, 2, 50, 400):
        text = np.append(random.integers(1, 3, n), 0)
        assert dc.suffix_order(text).tolist() == sorted(range(n + 1), key=lambda i: text[i:].tolist())


def test_windows_of_a_block_fit_a_bounded_memory():
    """A block of passages costs the driver a bounded multiple of its text, whatever the number of blocks."""
    import tracemalloc

    random = np.random.default_rng(7)
    words = [f"word{i}" for i in range(20_000)]
    rows = [(str(i), " ".join(random.choice(words, 400))) for i in range(700)]
    size = sum(len(t) for _, t in rows)
    tracemalloc.start()
    made = dc.passages(rows, 13)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(made.windows) == len(made.lengths) > 250_000 and made.windows.dtype == np.int32
    assert most < 60 * size and 64 * dc.BLOCK_BYTES < 1 << 30


def test_items_of_equal_windows_are_all_named():
    made = dc.passages([("b", "x y z"), ("a", "x y z w"), ("a", "x y"), (None, "x y z"), ("c", None)], 3)
    own = {tuple(w[w >= 0].tolist()): [made.names[i] for i in made.items[made.first_item[k] : made.first_item[k + 1]]] for k, w in enumerate(made.windows)}
    x, y, z, w = (made.vocabulary[v] for v in (b"x", b"y", b"z", b"w"))
    assert own == {(x, y, z): ["a", "b", "null"], (y, z, w): ["a"], (x, y): ["a"]}


def test_empty_tables(spark):
    assert answer(spark, [], ITEMS) == []
    got = answer(spark, DOCS[:1], [])
    assert (got[0][1], got[0][2], got[0][3]) == (6, 0, [])


def test_passages_are_cut_from_texts(spark):
    documents = spark.createDataFrame([("Keep this. A b c D e. And this",), (None,)], "text string")
    found = dc.find_passages(documents, spark.createDataFrame([(1, "a b c d e")], "item_id long, text string"))
    assert [r["text"] for r in dc.remove_passages(found).collect()] == ["Keep this. . And this", None]
