"""Operator 13, PII: spans of personal data in whole texts, proposed by patterns, confirmed by checksums, weighed by context.

A pattern proposes a span of its kind. Validators confirm it: Luhn's sum for cards, mod 97 for account numbers (IBAN), the
ranges of parts and the counts of digits for the others. A span's score is its kind's own, more for what is confirmed,
more or less for words near it that speak for or against personal data. Spans of the base patterns (email, ip, card,
phone) stay whatever they score. Further spans need ``ACCEPT``, and must not meet a base span or a better one:

* card: whole groups of digits in a longer run, which is no card as a whole (a card beside another number);
* email: addresses written with [at] and [dot]; ip: addresses of version six;
* phone: national numbers beside a word for telephone; ssn: social security numbers beside a word for them;
* iban: account numbers of the length of their country.

Defined results: a null or empty text has no spans; texts are read whole, and places count code points; equal rows have
equal results; spans that start together stand longest first; an empty table has an empty result; other columns are not
read.
"""

from __future__ import annotations

import ipaddress
import re
from bisect import bisect_left, insort
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leksika.llm.common import pieces, table

#: Kinds in the order of results; the first four are those of the base patterns.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE = KINDS[:4]
#: Score from which a further span is accepted; code points around a span that are its context.
ACCEPT, NEAR = 0.5, 48
#: Score of a proposed span, what a confirmation adds, and what a word for or against it adds or takes.
OWN = {"email": 0.5, "ip": 0.3, "card": 0.2, "phone": 0.2, "iban": 0.3, "ssn": 0.3}
CONFIRMED, FOR, AGAINST = 0.3, 0.25, 0.25

SPANS = "doc_id long, spans array<struct<kind:string,start:int,end:int,score:double,base:boolean>>"

# Patterns. Each reads its text in time proportional to its length: a run of characters is entered where it begins.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
RUN = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
GROUP = re.compile(r"[0-9]+")
AT = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[\[({]at[\])}] ?[A-Za-z0-9-]++(?: ?(?:\.|[\[({]dot[\])}]) ?[A-Za-z0-9-]++)++", re.I)
IP6 = re.compile(r"(?<![0-9A-Za-z:.])[0-9A-Fa-f:]++(?![0-9A-Za-z.])")
NATIONAL = re.compile(r"(?<![0-9+.-])(?:\([0-9]{3,5}\) ?|[0-9]{3,5}[ .-])[0-9]{3}[ .-]?[0-9]{2}[ .-]?[0-9]{2}(?![0-9])")
SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}([- ])(?!00)[0-9]{2}\1(?!0000)[0-9]{4}(?![0-9-])")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")

# Lengths of account numbers by country, as their registry states them.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18,
    "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22,
    "IL": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27,
    "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27,
    "TN": 24, "TR": 26, "UA": 29, "VG": 24, "XK": 20,
}
#: Groups of digits in which cards are written.
CARD_GROUPS = {(4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (4, 4, 4, 4, 3)}

# Words that speak for a kind, and words that speak against any number.
WORDS_FOR = {
    "email": re.compile(r"\b(?:e-?mail|mail|correo|courriel|kontakt|contact|contacto|write to)\b", re.I),
    "ip": re.compile(r"\b(?:ip|ipv6|host|server|address|adresse|login|client|dirección)\b", re.I),
    "card": re.compile(r"\b(?:card|credit|visa|mastercard|amex|karte|kreditkarte|carte|tarjeta|payment|cvv|expires?)\b", re.I),
    "phone": re.compile(r"\b(?:phone|tel|telephone|telefon|téléphone|teléfono|mobile|cell|call|fax|whatsapp|handy)\b", re.I),
    "iban": re.compile(r"\b(?:iban|account|konto|compte|cuenta|bank|banque|banco|bic|swift)\b", re.I),
    "ssn": re.compile(r"\b(?:ssn|social security|social-security|tax id)\b", re.I),
}
WORDS_AGAINST = re.compile(r"\b(?:version|release|isbn|issn|serial|order|invoice|part no|sku|example|figure|table|chapter|section)\b", re.I)


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float
    base: bool


def luhn(digits: str) -> bool:
    """Whether the digits, every second doubled from the right, add up to a multiple of ten."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d)
        if i % 2:
            n = n * 2 - 9 * (n > 4)
        total += n
    return total % 10 == 0


def mod97(account: str) -> bool:
    """Whether an account number, its first four characters last and letters as 10 to 35, leaves 1 by 97."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost addresses: the run of name characters before each @, which no @ is part of, and the domain after it."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        met = DOMAIN.match(text, at) if start < at else None
        done = met.end() if met else at + 1
        if met:
            yield start, done
        at = text.find("@", done)


def byte_parts(span: str) -> bool:
    return all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or "0") < 256 for p in span.split("."))


def base_spans(text: str) -> Iterator[tuple[str, int, int]]:
    if "@" in text:
        for start, end in emails(text):
            yield "email", start, end
    if not DIGIT.search(text):
        return
    for m in IP.finditer(text):
        if byte_parts(m[0]):
            yield "ip", m.start(), m.end()
    for m in RUN.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(digits := "".join(GROUP.findall(m[0]))) <= 19 and luhn(digits):
            yield "card", m.start(), m.end()
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(map(len, GROUP.findall(m[0]))) <= 15:
                yield "phone", m.start(), m.end()


def inner_cards(text: str, start: int, end: int) -> Iterator[tuple[int, int, float]]:
    """Cards of whole groups in a longer run of digits; one group confirms more than four short ones."""
    groups = [(m.start(), m.end()) for m in GROUP.finditer(text, start, end)]
    for i in range(len(groups)):
        for j in range(i + 1, min(i + 5, len(groups)) + 1):
            sizes = tuple(e - s for s, e in groups[i:j])
            digits = "".join(text[s:e] for s, e in groups[i:j])
            if (len(sizes) == 1 and 14 <= sizes[0] <= 19 or sizes in CARD_GROUPS) and digits[0] in "3456" and luhn(digits):
                yield groups[i][0], groups[j - 1][1], 0.1 if len(sizes) == 1 else 0.0


def further_spans(text: str) -> Iterator[tuple[str, int, int, float]]:
    """kind, start, end and the score of a span beside the base patterns, before its context counts."""
    if "at" in text.lower() and ("[" in text or "(" in text or "{" in text):
        for m in AT.finditer(text):
            yield "email", m.start(), m.end(), OWN["email"] + CONFIRMED
    if not DIGIT.search(text):
        return
    for m in RUN.finditer(text):
        if m.end() - m.start() >= 14:
            for start, end, more in inner_cards(text, m.start(), m.end()):
                yield "card", start, end, OWN["card"] + CONFIRMED - 0.1 + more
    if ":" in text:
        for m in IP6.finditer(text):
            if m[0].count(":") >= 3:
                try:
                    ipaddress.IPv6Address(m[0])
                except ValueError:
                    continue
                yield "ip", m.start(), m.end(), OWN["ip"] + CONFIRMED
    for m in NATIONAL.finditer(text):
        yield "phone", m.start(), m.end(), OWN["phone"] + 0.1
    for m in SSN.finditer(text):
        yield "ssn", m.start(), m.end(), OWN["ssn"]
    for m in IBAN.finditer(text):
        size = IBAN_LENGTHS.get(m[0][:2], 0)
        places = [k for k, c in enumerate(m[0]) if c != " "]
        if 0 < size <= len(places):
            end = m.start() + places[size - 1] + 1
            if not text[end : end + 1].isalnum() and mod97("".join(m[0][k] for k in places[:size])):
                yield "iban", m.start(), end, OWN["iban"] + CONFIRMED


def in_context(text: str, kind: str, start: int, end: int) -> float:
    """What the words near a span add to its score."""
    near = text[max(0, start - NEAR) : start] + " | " + text[end : end + NEAR]
    return FOR * bool(WORDS_FOR[kind].search(near)) - AGAINST * bool(WORDS_AGAINST.search(near))


def apart(ranges: Iterator[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same places as ranges that don't meet, in order."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def spans_of(text: str) -> list[Span]:
    """All spans of a text: those of the base patterns, and further ones that are accepted."""
    found = [Span(kind, s, e, round(min(1.0, OWN[kind] + CONFIRMED + in_context(text, kind, s, e)), 3), True) for kind, s, e in base_spans(text)]
    more = []
    for kind, s, e, score in further_spans(text):
        score = round(min(1.0, score + in_context(text, kind, s, e)), 3)
        if score >= ACCEPT:
            more.append(Span(kind, s, e, score, False))
    if more:
        taken = apart((s.start, s.end) for s in found)
        for span in sorted(more, key=lambda x: (-x.score, x.start, x.start - x.end)):
            at = bisect_left(taken, (span.end, 0))
            if not at or taken[at - 1][1] <= span.start:
                insort(taken, (span.start, span.end))
                found.append(span)
    return sorted(found, key=lambda x: (KINDS.index(x.kind), x.start, -x.end))


def find(docs: DataFrame) -> DataFrame:
    """doc_id and the spans of each row's whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("base", pa.bool_())]))
        for part in pieces(batches):
            spans = [[s._asdict() for s in spans_of(t)] if t else [] for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(spans, kind)], ["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SPANS)


def redacted(docs: DataFrame) -> DataFrame:
    """doc_id, text: spans are replaced by their kinds in brackets; where they overlap, the first and longest counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            texts = []
            for text in part.column("text").to_pylist():
                out, done = [], 0
                for s in sorted(spans_of(text or ""), key=lambda x: (x.start, -x.end)):
                    if s.start >= done:
                        out += [text[done : s.start], f"[{s.kind}]"]
                    done = max(done, s.end)
                texts.append(None if text is None else "".join([*out, text[done:]]))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, text string")


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digests(docs: DataFrame) -> DataFrame:
    """The contract's columns: counts and digest of the base spans, and all spans."""
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in BASE]
    return find(docs).select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def find_private(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
