import hashlib
import re

import pytest

from riskbook.llm import pii as P

PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in doubled) % 10 == 0


def brute(text):
    out = []
    for order, (kind, pattern) in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda: 14 <= len(digits) <= 19 and luhn(digits),
                "phone": lambda: 10 <= len(digits) <= 15,
            }[kind]()
            if good:
                out.append((m.start(), order, kind, m.end()))
    return sorted(out)


ODD = [
    "é😀 a@b.c_d@e.f x@y a@b@c.d.",
    "1.2.3.4.5.6.7.8 256.1.1.1 000255.1.1.1 1..2 99999999999999999999.1.1.1",
    "4111 1111 1111 1111, 4111-1111-1111-1111x 41111111111111112 4111  1111 1111 1111",
    "+1 (555) 123-4567) +12 +1.2.3 ++49 30 1234567",
    "--a@b-.c 1-2-3 +4111111111111111",
    None,
    "",
]


def check(rows, found):
    texts = dict(rows)
    assert len(found) == len(rows)
    for r in found:
        spans = brute(texts[r["doc_id"]])
        assert [r[f"n_{k}"] for k in P.BASE] == [sum(s[2] == k for s in spans) for k in P.BASE], texts[r["doc_id"]]
        joined = ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest(), (texts[r["doc_id"]], r["spans"])


def test_base_spans_equal_those_by_hand(table, documents):
    rows = [*enumerate(ODD, 10**6), *[(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]]
    check(rows, P.digests(table(*rows, extra=True)).collect())


def test_added_kinds_are_confirmed_by_checksum_or_context(table):
    docs = table(
        (1, "GB82WEST12345698765432 and DE89370400440532013000, not GB82WEST12345698765433."),
        (2, "my ssn: 123-45-6789"),
        (3, "order 123-45-6789"),
        (4, "call 555-123-4567 now"),
        (5, "item 555-123-4567 now"),
    )
    found = {r["doc_id"]: r["spans"] for r in P.digests(docs).collect()}
    assert found == {1: "iban:0:22,iban:27:49", 2: "ssn:8:19", 3: "", 4: "local_phone:5:17", 5: ""}


def test_context_moves_the_score(table):
    found = P.digests(table((1, "x 10.0.0.1 y"), (2, "server 10.0.0.1 y"))).collect()
    assert {r["doc_id"]: r["scores"] for r in found} == {1: "0.6", 2: "1.0"}


def test_masked_text(table):
    docs = table((1, "mail é@a.b to a.b@c.de, 10.0.0.1!"), (2, None), (3, ""), extra=True)
    found = P.masked(docs)
    assert found.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in found.collect()} == {1: "mail é@a.b to <email>, <ip>!", 2: None, 3: ""}


@pytest.mark.parametrize("text", ["+" * 100_000, "1" * 300_000, "a." * 100_000, "1 " * 100_000 + "@", "a@" * 50_000, "é" * 200_000 + " a@b.cd"])
def test_very_long_texts_take_little_time(table, text):
    (row,) = P.digests(table((1, text))).collect()
    assert row["n_email"] == int(text.endswith("a@b.cd"))
    if row["n_email"]:
        assert row["spans"] == "email:200001:200007"


def test_no_rows_and_repeated_rows(table):
    assert P.digests(table().limit(0)).count() == 0
    assert P.digests(table((1, "a@b.c"), (1, "a@b.c"), (None, "a@b.c"))).count() == 3


def test_no_python_in_the_plan(documents):
    plan = P.digests(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
