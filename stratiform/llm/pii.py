"""Personal data: regular expressions propose spans, checksums confirm them, nearby words adjust the score.

The four base kinds (email, ip, card, phone) follow fixed patterns and stay whatever their score is. The
kinds iban, nino and ssn are added by the method: a proposed span counts if its checksum or structure holds
and its score, raised by context words within `CONTEXT` characters, reaches `threshold`.

Every search is linear in the text. Positions are code points, ends exclusive. Nothing is shuffled.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.llm.common import map_texts, table

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "nino", "ssn")
KINDS = BASE_KINDS + ADDED_KINDS
CONTEXT = 48
THRESHOLD = 0.6

# Fixed patterns. A maximal run of digits decides alone whether a match starts in it, hence the look-behinds;
# possessive repeats do not change what matches, as nothing they could give back fits what follows.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
#: Characters of an IBAN by country, registered or in use; of other codes the whole match is taken.
IBAN_LENGTHS = {
    code: int(length)
    for code, length in re.findall(
        r"([A-Z]{2})([0-9]{2})",
        "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 "
        "ES24 FI18 FK18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 "
        "LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 "
        "PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 "
        "YE30 AO25 BF28 BJ28 CF27 CG27 CI28 CM27 CV25 DZ26 GA27 GQ27 GW25 IR26 KM27 MA28 MG27 ML28 MZ25 NE28 SN28 TD27 TG28",
    )
}
NINO = re.compile(r"(?<![A-Za-z0-9])[A-CEGHJ-PR-TW-Z][A-CEGHJ-NPR-TW-Z] ?[0-9]{2} ?[0-9]{2} ?[0-9]{2} ?[A-D](?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])(?!000|666|9[0-9]{2})[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")

#: How sure a confirmed span is without context.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "nino": 0.5, "ssn": 0.5}
RAISE, LOWER = 0.25, 0.3
HINTS = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "address", "host", "server", "login"),
    "card": ("card", "visa", "credit", "payment", "karte", "tarjeta", "carte"),
    "phone": ("phone", "call", "tel", "mobile", "fax", "contact"),
    "iban": ("iban", "bank", "account", "konto", "cuenta", "compte"),
    "nino": ("insurance", "nino", "national"),
    "ssn": ("ssn", "social", "security", "taxpayer"),
}
DOUBTS = ("version", "isbn", "order", "example", "sample", "test", "invoice", "serial")
WORD = re.compile(r"[^\W\d_]+")

SPAN_TYPE = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
        T.StructField("score", T.DoubleType()),
    ]
)
DERIVED = T.StructType([T.StructField("pii", T.ArrayType(SPAN_TYPE))])


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """The check of an IBAN: country and check digits moved behind, letters as 10 to 35, remainder 1."""
    rest = 0
    for c in iban[4:] + iban[:4]:
        value = int(c, 36)
        rest = (rest * (100 if value > 9 else 10) + value) % 97
    return rest == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: the local part is the whole run before an @, as far as the match before leaves it."""
    at, last = text.find("@"), 0
    while at >= 0:
        if at >= last:
            start = at
            while start > last and text[start - 1] in LOCAL:
                start -= 1
            if start < at and (m := DOMAIN.match(text, at + 1)):
                yield start, m.end()
                last = m.end()
        at = text.find("@", at + 1)


def ibans(text: str) -> list[tuple[int, int]]:
    """Spans whose checksum holds: of the country's length, or for codes without one the whole match.

    A match may run on into the words behind, or start in a word before, so after one that fails the search
    goes on at the next word, after one that holds behind it. Spans of a country's length come first.
    """
    at, found, others = 0, [], []
    while m := IBAN.search(text, at):
        at = m.start() + 1
        length = IBAN_LENGTHS.get(m[0][:2])
        if length is None:
            if mod97(m[0].replace(" ", "")):
                others.append(m.span())
            continue
        end, taken = m.start(), 0
        while end < m.end() and taken < length:
            taken += text[end] != " "
            end += 1
        if taken == length and (end == m.end() or text[end] == " ") and mod97(text[m.start() : end].replace(" ", "")):
            found.append((m.start(), end))
            at = end
    free = []
    for start, end in others:
        near = bisect_left(found, (end, 0)) - 1
        if (near < 0 or found[near][1] <= start) and (not free or free[-1][1] <= start):
            free.append((start, end))
    return sorted(found + free)


def propose(text: str) -> Iterator[tuple[str, int, int]]:
    """Spans that pattern and checksum confirm, kind by kind, in order of start."""
    for start, end in emails(text):
        yield "email", start, end
    if DIGITS.search(text) is None:
        return
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            yield "ip", *m.span()
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield "card", *m.span()
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(map(str.isdigit, m[0])) <= 15:
                yield "phone", *m.span()
    for start, end in ibans(text):
        yield "iban", start, end
    for kind, pattern in (("nino", NINO), ("ssn", SSN)):
        for m in pattern.finditer(text):
            yield kind, *m.span()


def score(text: str, kind: str, start: int, end: int) -> float:
    """The prior of the kind, raised by a hint and lowered by a doubtful word among the words around."""
    near = f"{text[max(0, start - CONTEXT) : start]} {text[end : end + CONTEXT]}".lower()
    words = set(WORD.findall(near))
    value = PRIOR[kind]
    if words.intersection(HINTS[kind]):
        value += RAISE
    if words.intersection(DOUBTS):
        value -= LOWER
    return round(min(1.0, max(0.0, value)), 4)


def scan(text: str, threshold: float = THRESHOLD) -> list[tuple[str, int, int, float]]:
    found = [(kind, start, end, score(text, kind, start, end)) for kind, start, end in propose(text)]
    base = [(start, end) for kind, start, end, _ in found if kind in BASE_KINDS]
    kept = []
    for kind, start, end, value in found:
        if kind in ADDED_KINDS and (value < threshold or any(a < end and start < b for a, b in base) and kind != "iban"):
            continue
        kept.append((kind, start, end, value))
    return kept


def find_pii(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """`docs` with `pii`: spans of kind, start, end and score, ordered by kind as in `KINDS`, then start.

    Null and empty texts have no spans. Base spans are listed whatever their score; nino and ssn spans that
    overlap a base span are left out. Repeated rows are answered one by one; an input column named `pii` is
    replaced.
    """

    def run(texts: pa.Array) -> dict[str, object]:
        return {
            "pii": [
                [{"kind": k, "start": a, "end": b, "score": s} for k, a, b, s in scan(t or "", threshold)] for t in texts.to_pylist()
            ]
        }

    return map_texts(docs, text, DERIVED, run)


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def of_kind(kind: str) -> Column:
    return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long")


def redact(found: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The result of `find_pii` with every span of at least `threshold` replaced by its kind in brackets.

    Of overlapping spans the one that starts first is replaced, then the longer one.
    """
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for value, own in zip(texts, spans, strict=True):
            at, parts = 0, []
            for s in sorted(own if value is not None else [], key=lambda s: (s["start"], -s["end"])):
                if s["score"] >= threshold and s["start"] >= at:
                    parts += [value[at : s["start"]], f"[{s['kind'].upper()}]"]
                    at = s["end"]
            out.append(None if value is None else "".join([*parts, value[at:]]))
        return pd.Series(out, dtype=object)

    return found.withColumn(text, F.pandas_udf(cut, "string")(F.col(text), F.col("pii")))


def op4_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: counts by base kind, digest of the base spans, all spans."""
    found = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("pii", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select(
        "doc_id",
        *(of_kind(k).alias(f"n_{k}") for k in BASE_KINDS),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("pii")).alias("spans"),
    )
