import random
import re

from stratiform.llm import licenses as li

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = {c: c + 32 for c in range(65, 91)}
SCHEMA = "doc_id long, text string, labels string"


def brute(text):
    w = WORD.findall((text or "").translate(FOLD))
    places = [(i, label) for phrase, label in li.BASE.items() for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({p for _, p in places}))


def scan(spark, texts):
    frame = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], SCHEMA)
    return {r["doc_id"]: r for r in li.scan_licenses(frame).collect()}


def test_base_matches_brute_force(spark):
    source = random.Random(3)
    pieces = ["the", "mit", "license", "apache", "version", "2", "cc", "by", "nc", "x", "The MIT License", "é", "-", "\n"]
    texts = [None, "", " .,", "the mit license", "The MIT\nLicense the-mit-license", "cc by nc by nc cc by nc", "filler " * 50_000 + "CC BY-NC"]
    texts += [" ".join(source.choice(pieces) for _ in range(source.randint(0, 30))) for _ in range(200)]
    for i, r in scan(spark, texts).items():
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute(texts[i]), texts[i]
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1 and (r["n_base"] == 0 or r["score"] == 1)


def test_templates_are_found_where_they_stand(spark):
    texts = [f"some words before. {body}. and after {n}" for n, (_, body, _) in enumerate(li.TEMPLATES.values())]
    texts += ["rights all reserved", "words of the gnu general public licence", "plain prose " * 30, "all rights reserved " * 3]
    found = scan(spark, texts)
    for n, (label, body, _) in enumerate(li.TEMPLATES.values()):
        own = [m for m in found[n]["licenses"] if m["label"] == label and m["start"] == 3 and m["end"] == 3 + len(body.split())]
        assert own, body
        assert label in found[n]["labels"].split(",")
    n = len(li.TEMPLATES)
    assert [found[n + k]["labels"] for k in range(4)] == ["", "", "", "all-rights-reserved"]
    assert sorted(m["start"] for m in found[n + 3]["licenses"]) == [0, 3, 6]


def voted(text, postings):
    """Labels by the method, word by word: places with enough agreeing rare words, and all key phrases there."""
    w = WORD.findall((text or "").translate(FOLD))
    need, out = li.needed_votes(postings), set()
    for number, (label, body, phrases) in enumerate(li.TEMPLATES.values()):
        own, words = [(x, p) for x, n, p in postings if n == number], body.split()
        for start in range(-len(words), len(w)):
            if sum(0 <= start + p < len(w) and w[start + p] == x for x, p in own) < need[number]:
                continue
            stands = True
            for phrase in phrases:
                parts = phrase.split()
                at = start + next(i for i in range(len(words)) if words[i : i + len(parts)] == parts)
                stands = stands and at >= 0 and w[at : at + len(parts)] == parts
            if stands:
                out.add(label)
    return out


def test_labels_of_the_method_match_brute_force(spark):
    source = random.Random(8)
    bodies = [body.split() for _, body, _ in li.TEMPLATES.values()]
    texts = []
    for _ in range(150):
        w = list(source.choice(bodies))
        for _ in range(source.choice([0, 0, 1, 3, 8])):
            w[source.randrange(len(w))] = source.choice(["free", "license", "software", "x", "the", "2"])
        cut = source.randint(0, len(w) // 3)
        texts.append(" ".join(["pre"] * source.randint(0, 4) + w[cut:] + source.choice(bodies)[: source.randint(0, 9)]))
    frame = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], SCHEMA)
    worded = li.with_words(frame.withColumnRenamed("text", "body"), "body", "words")
    postings = li.rare_index(*li.document_frequencies(worded, li.licence_words()))
    labels = {r["doc_id"]: r["labels"] for r in li.scan_licenses(frame).collect()}
    for i, text in enumerate(texts):
        base = brute(text)[4]
        assert set(filter(None, labels[i].split(","))) == voted(text, postings) | set(filter(None, base.split(","))), text


def test_a_word_that_a_template_has_twice_votes_at_both_places():
    postings = li.rare_index(100, {}, {"t": ("t", "copy the copy of a copy", ("the copy",))}, indexed=2)
    assert [p for w, _, p in postings if w == "copy"] == [0, 2, 5]


def test_many_repeated_notices_take_linear_time(spark):
    texts = ["all rights reserved " * 40_000, ("released under the mit license " * 8000)]
    found = scan(spark, texts)
    assert len(found[0]["licenses"]) == 40_000 and found[0]["labels"] == "all-rights-reserved"
    assert len(found[1]["licenses"]) == 8000 and found[1]["n_base"] == 8000


def test_a_key_phrase_must_stand(spark):
    near = li.TEMPLATES["mit grant"][1].replace("free of charge", "free for charge")
    found = scan(spark, [near])
    assert found[0]["labels"] == "" and 0 < found[0]["score"] < 1


def test_empty_table_and_repeated_rows(spark):
    assert li.scan_licenses(spark.createDataFrame([], SCHEMA)).count() == 0
    frame = spark.createDataFrame([(None, "the mit license", "x")] * 3, SCHEMA)
    assert [r["n_base"] for r in li.scan_licenses(frame).collect()] == [1, 1, 1]
