"""Personal data: patterns propose spans, checksums confirm them, words nearby move the score."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from tabulare.llm.rows import id_and_bytes, slices

KINDS = ["email", "ip", "card", "phone", "iban", "ssn", "local_phone"]
BASE_KINDS = KINDS[:4]
KEEP_AT = 0.5
CONTEXT_CHARS = 48
NEAR_BONUS = 0.35

# What can follow the name of an address; the name itself is found from the mark backwards.
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
NAME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match can start at the first digit of a run only: where that fails, a later digit fails too.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")
NOT_DIGIT = re.compile("[^0-9]+")
WORD = re.compile(r"[a-z]+")
GROUP = re.compile(r"\x20?[A-Z0-9]{4}")
TAIL = re.compile(r"\x20?[A-Z0-9]{1,3}+(?![A-Za-z0-9])")
JOINED = re.compile(r"[A-Za-z0-9]")
MAX_GROUPS = 7
# Characters of an IBAN by country, from the public registry.
IBAN_LENGTHS = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
        25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}


class Proposal(NamedTuple):
    """A kind beyond the base ones: its pattern, its score by pattern alone and if confirmed, and telling words."""

    kind: str
    pattern: re.Pattern
    score: float
    confirmed: float
    near: frozenset[str]
    against: frozenset[str]


NUMBER_WORDS = frozenset(["order", "invoice", "version", "isbn", "serial", "part", "ticket"])
PROPOSALS = [
    Proposal(
        "iban",
        re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2}"),  # where it starts: see accounts()
        0.1, 0.9, frozenset(["iban", "account", "bank", "konto", "cuenta", "compte"]), frozenset(),
    ),
    Proposal(
        "ssn",
        re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])"),
        0.3, 0.3, frozenset(["ssn", "social", "security"]), NUMBER_WORDS,
    ),
    Proposal(
        "local_phone",
        re.compile(r"(?<![0-9A-Za-z+.-])\(?[2-9][0-9]{2}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9.-])"),
        0.3, 0.3, frozenset(["tel", "phone", "telephone", "call", "mobile", "fax", "telefon"]), NUMBER_WORDS,
    ),
]


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        n = ord(digit) - 48
        n = n * 2 if i % 2 else n
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def mod97(account: str) -> bool:
    """Whether an IBAN's check digits are right."""
    compact = account.replace(" ", "")
    if not 15 <= len(compact) <= 34:
        return False
    return int("".join(str(int(c, 36)) for c in compact[4:] + compact[:4])) % 97 == 1


def account_ends(text: str, end: int) -> list[int]:
    """Where an account number whose second group ends at ``end`` can end, the longest first."""
    ends = []
    for _ in range(2, MAX_GROUPS + 1):
        if tail := TAIL.match(text, end):
            ends.append(tail.end())
        if not JOINED.match(text, end):
            ends.append(end)
        group = GROUP.match(text, end)
        if not group:
            break
        end = group.end()
    return sorted(set(ends), reverse=True)


def accounts(text: str, starts: re.Pattern) -> list[tuple[int, int]]:
    """IBANs whose check digits are right, by where they start.

    An upper-case word or code before or after an IBAN looks like more of its
    groups. So the country's length decides where it ends; a country without
    one has each of the few possible ends tried, the longest first, and gives
    way to the others. Where no end is right the search goes on at the next word.
    """

    def search(listed: bool) -> Iterator[tuple[int, int]]:
        at = 0
        while found := starts.search(text, at):
            start, at = found.start(), found.start() + 1
            length = IBAN_LENGTHS.get(text[start : start + 2])
            if (length is not None) == listed:
                for end in account_ends(text, found.end()):
                    account = text[start:end]
                    if (length or 0) in (0, len(account.replace(" ", ""))) and mod97(account):
                        yield start, end
                        at = end
                        break

    sure = list(search(True))
    found, held = [], 0
    for start, end in search(False):
        while held < len(sure) and sure[held][1] <= start:
            held += 1
        if held == len(sure) or end <= sure[held][0]:
            found.append((start, end))
    return sorted([*sure, *found])


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost addresses that do not overlap, in time linear in the text however long its runs of letters are."""
    done, at = 0, text.find("@")
    while at >= 0:
        start, following = at, at + 1
        while start > done and text[start - 1] in NAME:
            start -= 1
        if start < at and (found := DOMAIN.match(text, at)):
            yield start, found.end()
            done = following = found.end()
        else:
            done = following  # no name reaches back over a mark
        at = text.find("@", following)


def small_part(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def base_spans(text: str) -> Iterator[tuple[str, int, int]]:
    """Spans of the base kinds: each kind on its own, leftmost first; a match that fails its test is dropped."""
    for start, end in emails(text):
        yield "email", start, end
    if not DIGIT.search(text):
        return
    for found in IP.finditer(text):
        if all(map(small_part, found[0].split("."))):
            yield "ip", found.start(), found.end()
    for found in CARD.finditer(text):
        digits = NOT_DIGIT.sub("", found[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            yield "card", found.start(), found.end()
    for found in PHONE.finditer(text):
        if 9 <= len(NOT_DIGIT.sub("", found[0])) <= 15:
            yield "phone", found.start(), found.end()


def nearby(text: str, start: int, end: int) -> set[str]:
    before, after = text[max(0, start - CONTEXT_CHARS) : start], text[end : end + CONTEXT_CHARS]
    return set(WORD.findall(f"{before} {after}".lower()))


def find_spans(text: str) -> list[tuple[str, int, int, float]]:
    """All spans by start, then kind: the base ones with score 1, others whose score reaches ``KEEP_AT``."""
    spans = [(kind, start, end, 1.0) for kind, start, end in base_spans(text)]
    if DIGIT.search(text):
        for proposal in PROPOSALS:
            checked = proposal.kind == "iban"
            found = accounts(text, proposal.pattern) if checked else (m.span() for m in proposal.pattern.finditer(text))
            for start, end in found:
                score = proposal.confirmed if checked else proposal.score
                near = nearby(text, start, end)
                score += NEAR_BONUS * bool(near & proposal.near) - NEAR_BONUS * bool(near & proposal.against)
                if score >= KEEP_AT:
                    spans.append((proposal.kind, start, end, round(min(score, 1.0), 2)))
    return sorted(spans, key=lambda span: (span[1], KINDS.index(span[0])))


def find_pii(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: ``doc_id`` and its ``spans`` (kind, start, end, score), in code points with the end exclusive.

    A null or empty text has no spans; repeated rows and null keys each give a
    row; an empty table gives none. No shuffle; memory follows the longest text.
    """
    span = pa.struct(
        [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = [find_spans(raw.as_py().decode()) for raw in part.column("_text")]
            rows = [[dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in spans] for spans in found]
            yield pa.RecordBatch.from_arrays(
                [part.column("_id"), pa.array(rows, pa.list_(span))], names=["doc_id", "spans"]
            )

    schema = "doc_id bigint, spans array<struct<kind: string, start: bigint, end: bigint, score: double>>"
    return id_and_bytes(docs, key, text).mapInArrow(scan, schema)
