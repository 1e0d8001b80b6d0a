import random
import re

import pytest

from stratiform.llm import pii

BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(digits[::-1])) % 10 == 0


def holds(kind, found):
    digits = re.sub("[^0-9]", "", found)
    return {
        "email": True,
        "ip": kind == "ip" and all(int(p) <= 255 for p in found.split(".")),
        "card": 13 <= len(digits) <= 19 and luhn(digits),
        "phone": 9 <= len(digits) <= 15,
    }[kind]


def brute(text):
    return [(kind, *m.span()) for kind, pattern in BASE.items() for m in pattern.finditer(text) if holds(kind, m[0])]


def base(text):
    return [s[:3] for s in pii.scan(text) if s[0] in pii.BASE_KINDS]


@pytest.mark.parametrize("alphabet", ["a.@-1", "12. ", "+1 0().-", "a@b.c1.2+ é%_", "0 1-4@.+("])
def test_base_spans_match_the_plain_patterns(alphabet):
    source = random.Random(alphabet)
    for _ in range(4000):
        text = "".join(source.choice(alphabet) for _ in range(source.randint(0, 60)))
        assert base(text) == brute(text)


def test_added_kinds_need_checksum_or_context():
    kinds = lambda text: [s[0] for s in pii.scan(text)]
    assert kinds("IBAN GB82 WEST 1234 5698 7654 32 ok") == ["iban"]
    assert "iban" not in kinds("IBAN GB83 WEST 1234 5698 7654 32 ok")
    assert kinds("my social security number 219-09-9998") == ["ssn"]
    assert kinds("part 219-09-9998") == []
    assert kinds("é" * 3 + " a.b@c.de") == ["email"]
    assert pii.scan("é a.b@c.de")[0][1:3] == (2, 10)


@pytest.mark.parametrize("iban", ["DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32", "NO93 8601 1117 947", "MT84 MALT 0110 0001 2345 MTLC AST0 01S"])
def test_ibans_end_where_they_end(iban):
    spans = lambda text: [text[a:b] for kind, a, b, _ in pii.scan(text) if kind == "iban"]
    for behind in ("", " ok", " BIC COBADEFFXXX", " BIC COBADEFF", " 50 EUR", " 1250 EUR", " EUR", " A", " 2024", ", 50", "\nBIC"):
        for before in ("IBAN ", "REF AB12 ", "ZZ99 AB12 IBAN "):
            assert spans(before + iban + behind) == [iban]
    assert spans(f"{iban} {iban}") == [iban, iban]
    assert spans(iban[:-1] + ("1" if iban[-1] != "1" else "2") + " BIC COBADEFF") == []
    assert spans(iban + "X") == []


def test_ibans_of_other_countries():
    rest = "ABCD 1234 5678 9012"
    check = next(c for c in range(2, 99) if pii.mod97(f"QQ{c:02}{rest}".replace(" ", "")))
    iban = f"QQ{check:02} {rest}"
    assert [s[:3] for s in pii.scan(f"{iban} ok") if s[0] == "iban"] == [("iban", 0, len(iban))]


def test_long_texts_stay_linear():
    for text in ("1" * 300_000, "a" * 300_000 + "@", "1." * 200_000, "+1" + " " * 300_000, "@a" * 100_000, "A1 " * 100_000):
        pii.scan(text)


def test_edge_rows_and_redaction(spark):
    docs = spark.createDataFrame(
        [(1, None, "x"), (2, "", "x"), (3, "to a@b.cd now", "x"), (3, "to a@b.cd now", "x"), (None, "4111 1111 1111 1111", "x")],
        "doc_id long, text string, pii string",
    )
    found = pii.find_pii(docs)
    rows = found.selectExpr("doc_id", "transform(pii, s -> s.kind) k").collect()
    assert sorted((r[0] or 0, r[1]) for r in rows) == [(0, ["card"]), (1, []), (2, []), (3, ["email"]), (3, ["email"])]
    assert sorted(r["text"] or "" for r in pii.redact(found).collect()) == ["", "", "[CARD]", "to [EMAIL] now", "to [EMAIL] now"]
    assert pii.find_pii(docs.limit(0)).count() == 0
