import hashlib
import re
from collections import Counter

from stratiform.llm import secrets

CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])[A-Za-z0-9+/_=-]{16,}")
SF = "/root/testdata/sf0.1"
SCHEMA = "doc_id long, text string, source string, score string"


def test_candidates_match_brute_force(spark):
    texts = [None, "", "a" * 40, "a1" * 8, "x a1a1a1a1a1a1a1a1 b2b2b2b2b2b2b2b2b2", "1234567890123456", "é0123456789abcdef0é", "=" * 20 + "1", "q1" * 100_000, "a1" * 8 + "\n" + "b1" * 8]
    frame = spark.createDataFrame([(i, t, None, "clash") for i, t in enumerate(texts)] + [(None, "a1" * 9, "x", None)] * 2, SCHEMA)
    rows = secrets.scan_secrets(frame).collect()
    want = Counter(
        (i, n, hashlib.sha256(c.encode()).hexdigest(), len(c)) for i, t in [*enumerate(texts), (None, "a1" * 9), (None, "a1" * 9)] for n, c in enumerate(CANDIDATE.findall(t or ""))
    )
    assert Counter((r["doc_id"], r["nth"], r["digest"], r["length"]) for r in rows) == want


def test_forest_removes_false_positives(spark):
    """Held-out findings whose label the features do not state: digests against secrets, by the words around."""
    made = []
    for i in range(400):
        digest = hashlib.sha1(str(i).encode()).hexdigest()
        made += [(f"api token = \"", digest, '" end', "", 1), ("see commit ", digest, " for more", "", 0), ("call ", str(int(digest, 16))[:16], " now", "", 0)]
    frame = spark.createDataFrame(made, "before string, candidate string, after string, path string, label int").repartition(2)
    model = secrets.train_forest(frame.where("substr(candidate, 1, 1) < 'a'"))
    held = secrets.with_features(frame.where("substr(candidate, 1, 1) >= 'a'"))
    rows = model.transform(secrets.assembled(held)).select("label", "prediction").collect()
    assert len(rows) > 200
    assert sum(r["label"] == r["prediction"] for r in rows) / len(rows) > 0.98


HELD_OUT = ("assigned digits of a key", "key in prose", "stand-in of words", "words joined")


def test_the_forest_is_right_where_the_rules_are_wrong(spark):
    """Kinds that the forest has not seen, with labels that no rule gave them."""
    made = secrets.planted_findings(spark, 150)
    seen = made.where(~secrets.F.col("kind").isin(*HELD_OUT))
    model = secrets.train_forest(seen)
    held = secrets.with_features(made.where(secrets.F.col("kind").isin(*HELD_OUT)))
    rows = model.transform(secrets.assembled(held)).select("kind", "label", "prediction", secrets.rule_label().alias("rule")).collect()
    right, by_rule = Counter(), Counter()
    for r in rows:
        right[r["kind"]] += r["label"] == r["prediction"]
        by_rule[r["kind"]] += r["label"] == r["rule"]
    assert by_rule["stand-in of words"] == 0 and by_rule["key in prose"] == 0
    assert right["stand-in of words"] >= 120 and right["key in prose"] >= 100, right
    assert sum(right.values()) >= 0.75 * len(rows) and sum(right.values()) > sum(by_rule.values()) + 100, (right, by_rule)


def test_held_out_sources_are_told(spark):
    """All kinds, in documents of sources that the forest has not seen."""
    made = secrets.planted_findings(spark, 150)
    unseen = secrets.F.col("path").isin("src/app/settings.py", "docs/readme.md") | (secrets.F.col("path") == "") & (secrets.F.crc32(secrets.F.encode("candidate", "UTF-8")) % 4 == 0)
    model = secrets.train_forest(made.where(~unseen))
    held = secrets.with_features(made.where(unseen))
    rows = model.transform(secrets.assembled(held)).select("kind", "label", "prediction", secrets.rule_label().alias("rule")).collect()
    wrong = Counter(r["kind"] for r in rows if r["label"] != r["prediction"])
    assert len(rows) > 400 and sum(wrong.values()) <= 0.03 * len(rows), wrong
    assert sum(r["label"] != r["rule"] for r in rows) > 0.2 * len(rows)


def test_false_positives_that_the_rules_keep_are_removed(spark):
    digest = hashlib.sha1(b"x").hexdigest()
    texts = [f'api_token = "{digest}"', 'password = "changeme123"', "secret: your-example-token-here2", f"token checksum sha256: {hashlib.sha256(b'y').hexdigest()}"]
    frame = spark.createDataFrame([(i, t, "docs/readme.md" if i in (1, 2) else "src/app.py", None) for i, t in enumerate(texts)], SCHEMA)
    got = {r["doc_id"]: r["secret"] for r in secrets.scan_secrets(frame, keep=["doc_id"]).collect()}
    found = secrets.candidates(frame, "text", "source", ["doc_id"])
    rules = {r["_kept0"]: r["label"] for r in found.select("*", secrets.rule_label().alias("label")).collect()}
    assert got == {0: True, 1: False, 2: False, 3: False} and rules[1] == 1 and rules[2] == 1


def test_planted_findings_are_the_same_in_every_run(spark):
    rows = [sorted(map(tuple, secrets.planted_findings(spark, 20).collect())) for _ in range(2)]
    assert rows[0] == rows[1] and len(rows[0]) == 20 * 17 and {r[-1] for r in rows[0]} == {0, 1}


def test_a_very_long_text_with_many_candidates(spark):
    text = "".join(f'token = "{hashlib.sha1(str(i).encode()).hexdigest()}"\n' for i in range(5000))
    frame = spark.createDataFrame([(1, text, None, None)], SCHEMA)
    rows = secrets.scan_secrets(frame, keep=["doc_id"]).collect()
    assert sorted(r["nth"] for r in rows) == list(range(5000)) and sum(r["secret"] for r in rows) > 4900


def test_planted_tokens_are_told_from_numbers(spark):
    rows = secrets.op6_forest_secrets(spark, SF).collect()
    assert {r["length"] for r in rows if r["secret"]} == {40} and {r["length"] for r in rows if not r["secret"]} == {16}


def test_one_label_only_and_empty_table(spark):
    frame = spark.createDataFrame([(1, "token = \"" + "ab12" * 10 + '"', None, None)], SCHEMA)
    assert [r["secret"] for r in secrets.scan_secrets(frame).collect()] == [True]
    one = spark.createDataFrame([("a ", "b1", " c", "", 0)], "before string, candidate string, after string, path string, label int")
    assert [r["score"] for r in secrets.scan_secrets(frame, findings=one).collect()] == [1.0]
    assert secrets.scan_secrets(frame.limit(0)).count() == 0


def test_assigned_values_are_candidates_of_their_own(spark):
    key, hexed = "ghp_" + "a1B2c3" * 6, "24be" * 8
    cases = [
        (f"API_TOKEN={key}", key), (f"export AWS_SECRET_KEY_2024={key}\n", key), (f"https://h.io/a?x=1&access_token={hexed}&y=2", hexed),
        (f"https://h.io/cb?token={hexed}", hexed), ("DB_PASSWORD=p@ss!w0rd.9", "p@ss!w0rd.9"), ('password = "hunter2hunter2"', "hunter2hunter2"), ("pwd: 'abc'", "abc"),
        ('password = "correct horse battery staple"', "correct horse battery staple"), (f'auth: "Bearer {hexed}"', hexed), ("secret=QUJDREVGR0hJSktMTU4x==", "QUJDREVGR0hJSktMTU4x=="),
        ('password = "it\'s a&b;c1"', "it's a&b;c1"), ("PASSWORD=a1&b,c?d", "a1&b,c?d"), ("f(password=abc1,user=x)", "abc1"), (f"auth_url=https://h.io/?access_token={hexed}&y=1", hexed),
        ('{"api_key": "s3cr3t"}', "s3cr3t"), ("password=", None), ("a password is kept", None), ("status=200", None),
    ]
    frame = spark.createDataFrame([(i, text, None, None) for i, (text, _) in enumerate(cases)], SCHEMA)
    found = secrets.candidates(frame, "text", None, ["doc_id"])
    rows = found.select("*", secrets.rule_label().alias("label")).collect()
    for i, (text, want) in enumerate(cases):
        own = {r["candidate"]: r["label"] for r in rows if r["_kept0"] == i}
        assert (want in own and text not in own) if want else not own, (text, own)
        if want and "Bearer" not in text:
            assert own[want] == 1, (text, own)


def test_forest_finds_short_and_assigned_secrets(spark):
    lines = []
    for i in range(300):
        digest = hashlib.sha1(str(i).encode()).hexdigest()
        lines += [f"API_TOKEN={digest}", f"https://h.io/{i % 7}?access_token={digest[:32]}&z=1", f'password = "{digest[:9]}"', f"see commit {digest} there", f"call {int(digest, 16) % 10**16:016d} now", f"token = get_{digest[:3]}(user)"]
    frame = spark.createDataFrame([(i, t, None, None) for i, t in enumerate(lines)], SCHEMA).repartition(2)
    got = {}
    for r in secrets.scan_secrets(frame, keep=["doc_id"]).collect():
        got.setdefault(r["doc_id"] % 6, []).append((r["length"], r["secret"]))
    for kind, length, secret in ((0, 40, True), (1, 32, True), (2, 9, True), (3, 40, False), (4, 16, False), (5, 7, False)):
        assert len(got[kind]) == 300 and {n for n, _ in got[kind]} == {length}
        assert sum(s == secret for _, s in got[kind]) > 290
