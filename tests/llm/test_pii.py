from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tests.llm.cases import documents
from weftline.llm import pii
from weftline.sources.tables import load

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    return [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text or "") if valid(k, m[0])]


def found(frame):
    rows = pii.find_pii(frame).collect()
    return [(r["text"], [(s["kind"], s["start"], s["end"]) for s in r["pii"]]) for r in rows]


TRICKY = [
    "a@b.c@d.e a@b.c+x@d.e +@x.y ..@a.b.c. @a.b x@y 🦆é a@b.co",
    "1.2.3.4.5.6.7.8 256.1.1.1 1.2.3 0000255.0.0.01 1.2.3.4",
    "4111 1111 1111 1111 4111-1111-1111-1112 41111111111111111111 4111  1111",
    "+1 (917) 555-2670 +12 +1....2 ++49 30 901820)( +1234567890123456 +123456789",
    "+1 234 567 8905@x.com 10.0.0.1@host.example.org",
    "a" * 20000 + "@" + "1" * 20000,
    "1 " * 20000,
    "1." * 20000,
    "x@y.z " * 700,
]


def test_base_spans_match_the_plain_patterns(spark):
    frame = spark.createDataFrame([(t,) for t in TRICKY], "text string")
    for text, spans in found(frame):
        assert [s for s in spans if s[0] in PLAIN] == brute(text), text[:80]


def test_base_spans_of_all_documents(spark, sf_dir):
    for text, spans in found(load(spark, sf_dir, "documents")):
        assert [s for s in spans if s[0] in PLAIN] == brute(text)


@pytest.mark.parametrize(
    "number, good",
    [("GB82 WEST 1234 5698 7654 32", True), ("GB82WEST12345698765432", True), ("GB82WEST12345698765433", False), ("DE89370400440532013000", True)],
)
def test_account_numbers(spark, number, good):
    [(_, spans)] = found(spark.createDataFrame([(f"Pay to {number}, thanks",)], "text string"))
    assert [s for s in spans if s[0] == "iban"] == ([("iban", 7, 7 + len(number))] if good else [])


def test_context_moves_the_score(spark):
    texts = ["SSN: 123-45-6789", "part 123-45-6789", "host 10.0.0.1", "version 10.0.0.1", "10.0.0.1"]
    rows = pii.find_pii(spark.createDataFrame([(t,) for t in texts], "text string")).collect()
    assert [[s["kind"] for s in r["pii"]] for r in rows] == [["ssn"], [], ["ip"], ["ip"], ["ip"]]
    assert [r["pii"][0]["score"] for r in rows[2:]] == [0.9, 0.3, 0.6]


def test_redaction_merges_overlaps(spark):
    def brute_redacted(text):
        out, at = "", 0
        for s, e, k in sorted((s, e, k) for k, s, e in brute(text)):
            if s >= at:
                out += text[at:s] + f"<{k.upper()}>"
            at = max(at, e)
        return out + text[at:]

    frame = spark.createDataFrame([(t,) for t in TRICKY], "text string")
    got = [r["text"] for r in pii.redact(frame).collect()]
    assert got == [brute_redacted(t) for t in TRICKY]


def test_odd_rows(spark):
    docs = documents(spark).withColumn("pii", F.lit("mine"))
    assert pii.redact(docs).count() == docs.count()
    assert pii.redact(docs).columns == docs.columns
    assert pii.find_pii(docs.limit(0), into="spans").count() == 0
    assert all(r["spans"] == [] for r in pii.find_pii(docs, into="spans").where("text IS NULL OR text = ''").collect())
