"""Personal data: patterns propose spans, checks confirm them, nearby words adjust their score.

Every kind has a pattern, a check on the match, a starting score, and words
that raise the score where they stand near the match.  A span is reported
where its score reaches ``REPORT``.  The base kinds (email, ip, card, phone)
start at that score, so that context can only add to them.  The other
kinds start below it unless a checksum confirms them:

=========  =============================================================  ===================
kind       proposed by                                                    confirmed by
=========  =============================================================  ===================
iban       two letters, two digits, 11 to 30 letters or digits            mod-97 remainder 1
ssn        3-2-4 digits                                                   number ranges, words
card       12 or 13 digits (the base kind has 14 to 19)                   Luhn, words
secret     a long token after a name such as password, token, key         the name before it
aws_key    AKIA and 16 capital letters or digits                          the prefix
=========  =============================================================  ===================

Texts go through Arrow batches of bounded size; every search starts where a
run of its characters starts, so a text without spaces costs no more than
another of its length.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REPORT = 0.5
#: characters on either side of a match in which context words count
NEAR = 40
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "card13", "secret", "aws_key")


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


# fixed values: the base kinds' patterns, with possessive repeats where nothing that follows could match what they give back
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# the other kinds
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_SECRET = re.compile(r"(?i)(?<![a-z0-9])(?:password|passwd|pwd|secret|token|api[_-]?key)[\"']?\x20?[:=]\x20?[\"']?([A-Za-z0-9_/+.-]{8,}+)")
_AWS = re.compile(r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])")
_WORDS = {
    "ssn": re.compile(r"(?i)\b(?:ssn|social|security|tax)"),
    "card13": re.compile(r"(?i)\b(?:card|visa|credit|debit|payment)"),
    "iban": re.compile(r"(?i)\b(?:iban|account|bank|konto)"),
}


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def mod97(iban: str) -> bool:
    rest = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in rest)) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: from each @, the local part reaches back to its run's start or the last match's end."""
    low = at = 0
    while (at := text.find("@", at)) >= 0:
        run = text[low:at]
        start = low + len(run.rstrip(_LOCAL))
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            yield start, m.end()
            low = at = m.end()
        else:
            at += 1
            low = at
    return


def base_spans(text: str) -> Iterator[Span]:
    if "@" in text:
        for start, end in emails(text):
            yield Span("email", start, end, REPORT)
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m[0].split(".")):
            yield Span("ip", m.start(), m.end(), REPORT)
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
            yield Span("card", m.start(), m.end(), REPORT)
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(digits_of(m[0])) <= 15:
                yield Span("phone", m.start(), m.end(), REPORT)


def context(text: str, kind: str, start: int, end: int) -> float:
    """What nearby words add to a span's score."""
    words = _WORDS.get(kind)
    if words is None:
        return 0.0
    before, after = text[max(0, start - NEAR) : start], text[end : end + NEAR]
    return 0.4 * bool(words.search(before)) + 0.2 * bool(words.search(after))


def added_spans(text: str) -> Iterator[Span]:
    for m in _IBAN.finditer(text):
        compact = m[0].replace(" ", "")
        if 15 <= len(compact) <= 34 and mod97(compact):
            yield Span("iban", m.start(), m.end(), 0.6 + context(text, "iban", m.start(), m.end()))
    for m in _SSN.finditer(text):
        area, group, serial = m[0].split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield Span("ssn", m.start(), m.end(), 0.3 + context(text, "ssn", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if 12 <= m.end() - m.start() <= 25 and 12 <= len(d := digits_of(m[0])) <= 13 and luhn(d):
            yield Span("card13", m.start(), m.end(), 0.3 + context(text, "card13", m.start(), m.end()))
    if "=" in text or ":" in text:
        for m in _SECRET.finditer(text):
            if any("0" <= c <= "9" for c in m[1]):
                yield Span("secret", m.start(1), m.end(1), 0.7)
    if "AKIA" in text:
        for m in _AWS.finditer(text):
            yield Span("aws_key", m.start(), m.end(), 0.9)


def find_spans(text: str) -> list[Span]:
    """All reported spans, by start, then kind as listed.  Base spans leave nothing out; added ones may overlap them."""
    added = [s for s in added_spans(text) if s.score >= REPORT]
    return sorted([*base_spans(text), *added], key=lambda s: (s.start, KINDS.index(s.kind)))


def masked(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans go as one, named by the first."""
    out, at = [], 0
    for s in spans:
        if s.start >= at:
            out += [text[at : s.start], f"[{s.kind.upper()}]"]
        at = max(at, s.end)
    return "".join([*out, text[at:]])


def listed(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def personal_data(docs: DataFrame) -> DataFrame:
    """For every row of ``docs`` (doc_id, text): n_email, n_ip, n_card, n_phone, base_sha256, spans, n_spans and max_score.

    Counts and the digest cover the base kinds; ``spans`` lists all spans.
    A null text counts as empty.  Equal rows get equal results, an empty
    table an empty result; other columns are not read.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {id_type}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, "
              "n_spans long, max_score double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [find_spans(t or "") for t in batch.column("text").to_pylist()]
            base = [[s for s in spans if s.kind in BASE_KINDS] for spans in found]
            columns = [batch.column("doc_id")]
            columns += [pa.array([sum(s.kind == k for s in b) for b in base], pa.int64()) for k in BASE_KINDS]
            columns.append(pa.array([hashlib.sha256(listed(b).encode()).hexdigest() for b in base], pa.string()))
            columns.append(pa.array([listed(s) for s in found], pa.string()))
            columns.append(pa.array([len(s) for s in found], pa.int64()))
            columns.append(pa.array([max((x.score for x in s), default=0.0) for s in found], pa.float64()))
            yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in schema.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def mask_personal_data(docs: DataFrame) -> DataFrame:
    """``docs`` with every span in ``text`` masked and ``n_chars``, if there, brought up to date; nulls stay null."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index("text")
        for batch in batches:
            texts = [None if t is None else masked(t, find_spans(t)) for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in names else out
