"""Spans against the plain patterns tried one by one, and the checks and words that move a score."""

import hashlib
import random
import re

from tabulare.llm import pii
from tabulare.llm.queries import LLM_JOBS

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_luhn(digits):
    doubled = [int(d) * (2 if i % 2 else 1) for i, d in enumerate(digits[::-1])]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def plain_spans(text):
    for kind, pattern in PLAIN.items():
        for found in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", found[0])
            if kind == "ip" and any(int(p) > 255 for p in found[0].split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and plain_luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            yield kind, found.start(), found.end()


def order(spans):
    return sorted(spans, key=lambda s: (s[1], list(PLAIN).index(s[0])))


def test_base_spans_equal_the_plain_patterns():
    made = random.Random(5)
    for alphabet in ("ab@.-+ 1", "0123456789.-+ ()", "a1.@%é ", "41 -+(). "):
        for _ in range(4000):
            text = "".join(made.choices(alphabet, k=made.randrange(40)))
            assert order(pii.base_spans(text)) == order(plain_spans(text)), repr(text)


def test_long_runs_take_linear_time():
    for text in ("a" * 2_000_000, "1" * 1_000_000, "1." * 500_000, "a@" * 500_000, "+1" * 500_000, "@" * 1_000_000):
        pii.find_spans(text)


def test_checks_and_context():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod97("DE89 3704 0044 0532 0130 00") and not pii.mod97("DE88 3704 0044 0532 0130 00")

    def kinds(text):
        return [s[0] for s in pii.find_spans(text) if s[0] not in pii.BASE_KINDS]

    assert kinds("pay to DE89 3704 0044 0532 0130 00 now") == ["iban"]
    assert kinds("pay to DE88 3704 0044 0532 0130 00 now") == []
    assert kinds("my ssn is 123-45-6789") == ["ssn"]
    assert kinds("part 123-45-6789") == []
    assert kinds("serial ssn 123-45-6789") == []
    assert kinds("call (212) 555-0123") == ["local_phone"] and kinds("see 212-555-0123") == []


def test_query_on_the_table_and_odd_rows(spark, folder):
    rows = {r.doc_id: r for r in LLM_JOBS["op5_pii"](spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(docs) and any(r.n_email for r in rows.values()) and any(r.n_card for r in rows.values())
    for doc in docs:
        base = order(plain_spans(doc.text))
        listed = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        row = rows[doc.doc_id]
        assert row.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(k == x[0] for x in base) for k in PLAIN]
        assert {f"{k}:{s}:{e}" for k, s, e in base} <= set(filter(None, row.spans.split(",")))
    odd = [(1, None, "x"), (1, "", "x"), (None, "é a@b.co", "y"), (1, "a@b.co", None)]
    docs = spark.createDataFrame(odd, "doc_id bigint, text string, spans string")
    found = sorted((r.doc_id or 0, [tuple(s)[:3] for s in r.spans]) for r in pii.find_pii(docs).collect())
    assert found == [(0, [("email", 2, 8)]), (1, []), (1, []), (1, [("email", 0, 6)])]
    assert pii.find_pii(docs.limit(0)).count() == 0


def test_ibans_beside_upper_case_words():
    def ibans(text):
        return [text[start:end] for kind, start, end, _ in pii.find_spans(text) if kind == "iban"]

    belgian, spanish, german = "BE68 5390 0754 7034", "ES9121000418450200051332", "DE89 3704 0044 0532 0130 00"
    for account in (belgian, spanish, german):
        for before in ("", "IBAN ", "Konto ", "AB12 CDEF GHIJ ", "XX11 "):
            for after in ("", ",", " BIC KREDBEBB", " BANK", " BANKING", " Please", " OK", " A1", " DEUTSCHE BUNDESBANK AG", " 1"):
                assert ibans(before + account + after) == [account], before + account + after
    assert ibans(f"{belgian} {spanish} {german}") == [belgian, spanish, german]
    assert ibans(belgian + "X") == ibans("X" + belgian) == ibans("BE69 5390 0754 7034 BANK") == []
    assert len(ibans(f"{belgian} BANK " * 20_000)) == 20_000
    for text in ("AB12" * 200_000, "AB12 " * 200_000, "AB12CDEFGHIJ " * 100_000):
        ibans(text)  # in linear time
