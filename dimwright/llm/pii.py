"""Personal data: regular expressions propose, checksums confirm, context adjusts the score.

Kinds and their rules (fixed by the contract for the first four):

* ``email``, ``ip`` (parts up to 255), ``card`` (12-19 digits, Luhn), ``phone``
  (``+`` and 9-15 digits) are the base kinds.  They are confirmed by their
  validator, so their score never falls below the threshold.
* ``iban`` (mod-97; words that follow a number are left off until it holds), ``ssn`` and ``local_phone`` are added by this method.  A shape
  alone scores below the threshold; a checksum or a context word nearby lifts it.

A span's score is its kind's prior, plus ``CHECKED`` if a checksum confirms it,
plus ``CONTEXT`` if one of the kind's context words stands within ``WINDOW``
characters on either side.  Spans with a score of at least ``THRESHOLD`` count.

Every scan is linear in the length of the text, also for a text that is one very
long run of digits or letters.

Defined cases: null and empty texts have no span; matches of one kind never
overlap, matches of different kinds may; repeated rows each get the same result;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimwright.llm.common import id_and_text, pieces_of, ship_package

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "ssn", "local_phone")
KINDS = BASE_KINDS + ADDED_KINDS

THRESHOLD, CHECKED, CONTEXT, WINDOW = 0.5, 0.5, 0.35, 40
PRIOR = {"email": 0.5, "ip": 0.5, "card": 0.3, "phone": 0.5, "iban": 0.2, "ssn": 0.25, "local_phone": 0.2}
CONTEXT_WORDS = {
    "email": ("mail", "contact"),
    "ip": ("ip", "address", "host", "server"),
    "card": ("card", "visa", "mastercard", "credit", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
    "iban": ("iban", "account", "bank", "konto"),
    "ssn": ("ssn", "social security"),
    "local_phone": ("phone", "tel", "call", "mobile", "fax", "telefon"),
}

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
# A match never ends inside a run of digits, so starting only at the run's first digit changes nothing.
_IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+.(-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9-])")
_DIGIT = re.compile("[0-9]")
_LOCAL_BYTES = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """The first four characters move to the end, letters become 10..35, the number is 1 modulo 97."""
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each ``@``: a match starts where its run of local characters does."""
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_BYTES:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            done = m.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _digits(s: str) -> str:
    return "".join(_DIGIT.findall(s))


def base_spans(text: str) -> Iterator[tuple[str, int, int]]:
    """Confirmed matches of the base kinds, kind by kind, leftmost and not overlapping; failing matches are dropped."""
    if "@" in text:
        for a, b in _emails(text):
            yield "email", a, b
    if not _DIGIT.search(text):
        return
    if "." in text:
        for m in _IP.finditer(text):
            if all(len(g.lstrip("0")) <= 3 and int(g.lstrip("0") or 0) <= 255 for g in m.groups()):
                yield "ip", m.start(), m.end()
    for m in _CARD.finditer(text):
        digits = _digits(m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            yield "card", m.start(), m.end()
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m.group())) <= 15:
                yield "phone", m.start(), m.end()


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """Confirmed matches, each the longest that ends at a word border; at most 31 ends are tried from one start."""
    m = _IBAN.search(text)
    while m:
        a, b = m.span()
        while b > a and not mod97(text[a:b].replace(" ", "")):
            b = text.rfind(" ", a, b)  # the words up to here
            if len(text[a : max(a, b)].replace(" ", "")) < 15:
                b = a
        if b > a:
            yield a, b
        m = _IBAN.search(text, b if b > a else a + 1)


def _added(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """Proposals of the added kinds, with whether a checksum confirms them."""
    if not _DIGIT.search(text):
        return
    for a, b in _ibans(text):
        yield "iban", a, b, True
    if "-" in text:
        for m in _SSN.finditer(text):
            yield "ssn", m.start(), m.end(), False
    for m in _LOCAL_PHONE.finditer(text):
        yield "local_phone", m.start(), m.end(), False


def _near(text: str, kind: str, start: int, end: int) -> bool:
    around = (text[max(0, start - WINDOW) : start] + " " + text[end : end + WINDOW]).lower()
    return any(re.search(rf"(?<![a-z]){re.escape(w)}", around) for w in CONTEXT_WORDS[kind])


def find_spans(text: str) -> list[Span]:
    """All spans of a text with their scores, by start and then kind."""
    out = []
    for kind, a, b in base_spans(text):
        score = PRIOR[kind] + (CHECKED if kind == "card" else 0) + (CONTEXT if _near(text, kind, a, b) else 0)
        out.append(Span(kind, a, b, min(1.0, max(THRESHOLD, score))))
    taken = sorted((s.start, s.end) for s in out)
    starts, reach = [x for x, _ in taken], list(accumulate((y for _, y in taken), max))
    for kind, a, b, checked in _added(text):
        before = bisect_left(starts, b)  # base spans that begin before this one ends
        if before and reach[before - 1] > a:
            continue  # a base span already covers it
        score = PRIOR[kind] + CHECKED * checked + (CONTEXT if _near(text, kind, a, b) else 0)
        if score >= THRESHOLD:
            out.append(Span(kind, a, b, min(1.0, score)))
    return sorted(out, key=lambda s: (s.start, KINDS.index(s.kind), s.end))


def _written(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, found) of every document; ``found`` holds kind,
    start, end (code points, end exclusive) and score of each span."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            found = [find_spans(t) for t in batch.column("text").to_pylist()]
            base = [[s for s in spans if s.kind in BASE_KINDS] for spans in found]
            counts = {f"n_{k}": pa.array([sum(s.kind == k for s in b) for b in base], pa.int64()) for k in BASE_KINDS}
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), **counts,
                "base_sha256": pa.array([hashlib.sha256(_written(b).encode()).hexdigest() for b in base], pa.string()),
                "spans": pa.array([_written(s) for s in found], pa.string()),
                "found": pa.array([[s._asdict() for s in spans] for spans in found], pa.list_(pa.struct([
                    ("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))),
            })

    return id_and_text(docs).mapInArrow(
        run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, "
        "found array<struct<kind: string, start: bigint, end: bigint, score: double>>")


def masked_text(text: str) -> str:
    """The text with every span replaced by its kind in square brackets; overlapping spans become one mark."""
    out, done = [], 0
    for s in find_spans(text):
        if s.start < done:
            done = max(done, s.end)
            continue
        out += [text[done : s.start], f"[{s.kind.upper()}]"]
        done = s.end
    return "".join(out) + text[done:]


def mask(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """``docs`` with masked texts and, where that column exists, new lengths; null texts stay null."""
    ship_package(docs.sparkSession)

    @F.pandas_udf("string")
    def masked(texts):
        return texts.map(masked_text, na_action="ignore")

    out = docs.withColumn(text_col, masked(F.col(text_col)))
    if length_col in docs.columns:
        kind = docs.schema[length_col].dataType
        length = F.when(F.col(length_col).isNotNull(), F.length(text_col)).cast(kind)
        out = out.withColumn(length_col, length)
    return out
