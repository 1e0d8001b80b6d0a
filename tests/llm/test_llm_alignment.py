"""Cross-tokenizer alignment against a plain walk over both token lists."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest

from stratiform.llm import alignment
from stratiform.llm.alignment import DERIVED, ByteBpe, PieceBpe, align_tokens, file_content, frequent_from, joined

FIRST = f"{alignment.VOCABULARIES}/{alignment.BYTE_VOCABULARY}"
SECOND = f"{alignment.VOCABULARIES}/{alignment.PIECE_MODEL}"


@pytest.fixture(scope="module")
def tokenizers():
    return ByteBpe(file_content(FIRST)), PieceBpe(file_content(SECOND))


def walked(text, first, second):
    """Ids of both sides and their groups, token by token."""
    a = first.plain.encode(" " + text, add_special_tokens=False).ids
    b = second.encode([text])[0]
    whole = (" " + text).encode()
    if joined(a, first.pool) != whole or joined(b, second.pool) != whole:
        return None
    groups, own, at, i, j = [], ([], []), [0, 0], 0, 0
    while i < len(a) or j < len(b):
        if at[0] <= at[1]:
            own[0].append(a[i])
            at[0] += len(first.pool[a[i]])
            i += 1
        else:
            own[1].append(b[j])
            at[1] += len(second.pool[b[j]])
            j += 1
        if at[0] == at[1]:
            groups.append(own)
            own = ([], [])
    return a, b, groups


def expected(texts, first, second):
    found = {t: walked(t, first, second) for t in set(texts) if t}
    links = {}
    for t, w in found.items():
        if w:
            links[t] = Counter()
            for ga, gb in w[2]:
                ca, cb = Counter(ga), Counter(gb)
                links[t].update({(x, y): m * n for x, m in ca.items() for y, n in cb.items()})
    counts, best = Counter(), defaultdict(int)
    for t in texts:
        counts.update(links.get(t, {}).keys())
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    rows = []
    for t in texts:
        if t not in links:
            rows.append((0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups = found[t]
        own = links[t]
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        rows.append(
            (
                len(a),
                len(b),
                len(groups),
                sum(own.values()),
                sum(n for p, n in own.items() if counts[p] == best[p[0]]),
                sum(n * counts[p] for p, n in own.items()),
                hashlib.sha256(text.encode()).hexdigest(),
            )
        )
    return rows


TEXTS = [
    None,
    "",
    " ",
    "a",
    "Hello, world!",
    "Hello, world!",
    "  two  spaces \n\n\t tabs\r\n",
    "<|endoftext|> and <s> </s> <unk> <0x41> are plain text",
    "▁ already a piece mark",
    "naïve café — Ünïcode 你好世界 🙂🙃 ​ \u0085",
    "x" * 5000,
    "=-" * 4000,
    " " * 3000 + "end",
    "word " * 3000,
    "don't we'll I've they're",
    "\x00\x01\x7f",
]


@pytest.mark.parametrize("broadcast_pairs", [alignment.BROADCAST_PAIRS, 40, 0])
def test_measures_equal_a_plain_walk(spark, tokenizers, broadcast_pairs):
    rng = random.Random(5)
    texts = TEXTS + ["".join(rng.choice(["ab", " ", "tion", "é", "9", "\n", "世", "the "]) for _ in range(rng.randrange(60))) for _ in range(120)]
    texts += ["copied text"] * 60
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    found = align_tokens(docs, keep=["doc_id"], broadcast_pairs=broadcast_pairs)
    got = {r["doc_id"]: tuple(r[c] for c in DERIVED) for r in found.collect()}
    assert [got[i] for i in range(len(texts))] == expected(texts, *tokenizers)


def test_one_entry_of_a_hot_text_leaves_the_shuffle(spark, tokenizers):
    docs = spark.createDataFrame([(i, "one text for all") for i in range(4000)], "doc_id long, text string").repartition(6)
    rows = align_tokens(docs, keep=["doc_id"]).select(*DERIVED).distinct().collect()
    (want,) = set(expected(["one text for all"] * 4000, *tokenizers))
    assert [tuple(r) for r in rows] == [want] and want[5] == 4000 * want[3]


def test_both_encoders_of_the_byte_level_agree(tokenizers):
    first, _ = tokenizers
    assert first.fast is not None
    points = [c for c in range(1, 0x3000) if not 0xD800 <= c < 0xE000] + list(range(0xFE00, 0x10000, 7)) + list(range(0x1F300, 0x1F700, 5))
    for i in range(0, len(points), 500):
        text = " ".join(f"ab{chr(c)}cd 12{chr(c)}34 {chr(c)}{chr(c)}  x" for c in points[i : i + 500])
        assert first.fast.encode_ordinary(text) == first.plain.encode(text, add_special_tokens=False).ids


def test_extra_and_clashing_columns_and_the_groups_themselves(spark, tokenizers):
    docs = spark.createDataFrame([(1, "Hello", 7, "x"), (2, None, 8, "y")], "doc_id long, text string, n_a int, `a.b` string")
    found = align_tokens(docs, with_groups=True)
    assert found.columns == ["doc_id", "text", "a.b", *DERIVED, "groups"]
    by_id = {r["doc_id"]: r for r in found.collect()}
    a, b, groups = walked("Hello", *tokenizers)
    text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
    assert by_id[1]["groups"] == text and by_id[1]["n_a"] == len(a) and by_id[1]["a.b"] == "x"
    assert by_id[2]["groups"] == "" and by_id[2]["groups_sha256"] == "" and by_id[2]["n_links"] == 0


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert align_tokens(docs).count() == 0
    nulls = spark.createDataFrame([(None, None), (None, "")], "doc_id long, text string")
    assert [r["n_links"] for r in align_tokens(nulls).collect()] == [0, 0]


def test_the_broadcast_share_is_bounded(spark):
    counts = spark.createDataFrame([(i, n) for i, n in enumerate([1000, 600, 500, 40, 33, 3, 2, 1, 1])], "pair long, count long")
    for most in (0, 1, 2, 3, 5, 8, 9):
        least = frequent_from(counts, most)
        assert counts.where(f"count >= {least}").count() <= most
    assert frequent_from(counts, 9) == 1 and frequent_from(counts, 5) == 32
