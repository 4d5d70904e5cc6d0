"""Raw bytes to entries: JSON and HTML by the standard library's parsers, in one map over Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from html.parser import HTMLParser
from itertools import islice
from typing import NamedTuple
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from leksika.operators import payloads
from leksika.operators.payloads import first_of  # noqa: F401

# Where the fields of an entry stand in markup, word classes, and the patterns of numbering, labels and phrases.
HEADWORD = (".lema", ".kata", "h1", "h2", ".word", "title")
WORD_CLASS = ("kelas-kata", "kelaskata", "kelas", "pos", "word-class")
SENSE = ("makna", "definisi", "arti")
VARIANT = ("bentukTidakBaku", "bentuk-tidak-baku", "bentuk_tidak_baku", "tidak-baku", "tidakBaku", "varian", "nonstandard", "bentukTidakBakuSpan")
CLASSES = frozenset(("n", "v", "a", "adv", "pron", "num", "p", "interj", "konj", "prep", "adj"))
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"))
OUTSIDE = ("nav", "header", "footer")
TITLE_SUFFIX, HOMONYM = " - ", re.compile(r"\s+\d+$")
NUMBERING, NEXT_NUMBER = re.compile(r"^\s*\d+[.)]\s*"), re.compile(r"\s*\d+[.)]\s+")
EXAMPLE, EXAMPLE_LABEL = re.compile(r"(?i)contoh\s*:"), re.compile(r"(?i)^contoh\s*:\s*")
VARIANT_LABEL = re.compile(r"(?i)^bentuk\s+tidak\s+baku\s*")
VARIANT_PHRASES = (re.compile(r"(?i)bentuk\s+tidak\s+baku\s*[:\-]\s*([a-z0-9,\s\-]+)"), re.compile(r"(?i)bentuk\s+tidak\s+baku\s+([a-z]+)"))
LIST_MARKS, CLASS_MARKS, LAST_MARKS = re.compile("[,;]"), re.compile(r"[,;/\s]+"), re.compile("[.;:]+$")
LEAST_ITEM, LEAST_BLOCK, LEAST_PARAGRAPH, LEAST_I, LEAST_EM = 5, 5, 10, 5, 8
ENTRY = "id string, lema string, kelas_kata array<string>, makna array<string>, contoh array<string>, bentuk_tidak_baku array<string>, error string"
#: With what only JSON can say of an entry.
WHOLE_ENTRY = ", ".join((ENTRY, *(f"{name} string" for name in payloads.OPTIONAL)))


#: Tags and classes that matter for what stands within them.
AROUND = frozenset((*SENSE, *OUTSIDE, "ol", "ul", "li"))


class Node:
    """An element: its tag, classes, children and texts in order."""

    def __init__(self, tag: str, classes: tuple[str, ...], parent: Node | None):
        self.tag, self.classes, self.parent, self.parts, self.said = tag, classes, parent, [], None
        #: Which of ``AROUND`` the elements around it are.
        self.around: frozenset[str] = parent.around if parent else frozenset()
        if parent and (new := AROUND.intersection((parent.tag, *parent.classes)) - self.around):
            self.around |= new

    def walk(self) -> Iterator[Node]:
        """All elements below, in order; markup may be nested as deep as it likes."""
        stack = [self]
        while stack:
            node = stack.pop()
            if node is not self:
                yield node
            stack.extend(p for p in reversed(node.parts) if isinstance(p, Node))

    def text(self) -> str:
        """The cleaned text of an element; a short one is put together once."""
        if self.said is not None:
            return self.said
        text = self.gathered()
        if len(text) <= 1000:
            self.said = text
        return text

    def gathered(self) -> str:
        pieces: list[str] = []
        stack: list[Node | str] = [self]
        while stack:
            top = stack.pop()
            if isinstance(top, str):
                pieces.append(top.strip())
            else:
                stack.extend(reversed(top.parts))
        return clean(" ".join(p for p in pieces if p))

    def inside(self, *names: str) -> bool:
        """Whether an element around it has one of these tags or classes of ``AROUND``."""
        return not self.around.isdisjoint(names)


class Tree(HTMLParser):
    """Builds nodes; an end tag without a beginning is ignored, an open element ends with its parent."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.root = self.now = Node("", (), None)
        self.feed(html)
        self.close()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "li" and self.now.tag == "li" or tag == "p" and self.now.tag == "p":
            self.now = self.now.parent
        node = Node(tag, tuple((dict(attrs).get("class") or "").split()), self.now)
        self.now.parts.append(node)
        if tag not in VOID:
            self.now = node

    def handle_endtag(self, tag: str) -> None:
        node = self.now
        while node.parent is not None and node.tag != tag:
            node = node.parent
        if node.parent is not None:
            self.now = node.parent

    def handle_data(self, data: str) -> None:
        if self.now.tag not in ("script", "style"):
            self.now.parts.append(data)


def clean(text: str) -> str:
    return " ".join(re.sub("[​‌‍﻿]", "", text).split())


def distinct(items: list[str]) -> list[str]:
    return list(dict.fromkeys(i for i in map(str.strip, items) if i))


class Rule(NamedTuple):
    """Where values may stand, and how each text found there becomes values: the first rule that yields any decides."""

    where: Callable[[Node], bool]
    values: Callable[[str], list[str]]
    only_first: bool = False


def by_rules(nodes: list[Node], rules: Iterable[Rule]) -> list[str]:
    """The values of the first rule that has some."""
    for rule in rules:
        met = (n for n in nodes if rule.where(n))
        found = [v for n in (islice(met, 1) if rule.only_first else met) for v in rule.values(n.text()) if v]
        if found:
            return found
    return []


def of_class(*names: str) -> Callable[[Node], bool]:
    return lambda n: any(c in names for c in n.classes)


def of_tag(*names: str) -> Callable[[Node], bool]:
    return lambda n: n.tag in names


def word_in(url: str) -> str:
    """the word that a page's address ends in; capitalised if it has lower-case letters only."""
    word = clean(unquote(url.rstrip("/").rsplit("/", 1)[-1]))
    return word[0].upper() + word[1:] if word.islower() else word


def headword(nodes: list[Node], url: str) -> str:
    """The word in the first place that has one, without homonym numbers and, in a title, what follows the dash; else that of the address."""

    def rule(place: str) -> Rule:
        shorten = (lambda t: t.partition(TITLE_SUFFIX)[0]) if place == "title" else (lambda t: t)
        return Rule(of_class(place[1:]) if place.startswith(".") else of_tag(place), lambda t: [HOMONYM.sub("", shorten(t))], only_first=True)

    return next(iter(by_rules(nodes, map(rule, HEADWORD))), None) or word_in(url)


def word_classes(nodes: list[Node], whole: str) -> list[str]:
    """Known classes and other words of up to four letters; else a class in parentheses."""
    found = []
    for node in nodes:
        if any(c in WORD_CLASS for c in node.classes):
            for part in CLASS_MARKS.split(node.text()):
                word = part.lower()
                if word.strip(".") in CLASSES or (len(word) <= 4 and word.isalpha()):
                    found.append(word.strip("."))
    if not found and (m := re.search(rf"(?i)\(\s*({'|'.join(sorted(CLASSES, key=len, reverse=True))})\s*\)", whole)):
        found.append(m[1].lower())
    return distinct(found)


def definition(text: str) -> str:
    """without numbering and what follows ``contoh:``."""
    return clean(EXAMPLE.split(NUMBERING.sub("", text), maxsplit=1)[0])


def block_definitions(text: str) -> list[str]:
    """F07, F08 for a text that numbers several senses."""
    return [EXAMPLE.split(part, maxsplit=1)[0].strip() for part in map(clean, NEXT_NUMBER.split(text)) if len(part) >= LEAST_BLOCK]


def senses(nodes: list[Node]) -> list[str]:
    """List items of a sense container, else of an ordered, then an unordered list outside navigation; else what the container says as a whole, else a paragraph.

    The first container or list with items decides, even if none of them has a definition.
    """
    item = lambda t: [definition(t)]

    def items_of(name: str) -> Callable[[Node], bool]:
        return lambda n: n.tag == "li" and n.inside(name)

    def items_of_list(kind: str) -> Callable[[Node], bool]:
        return lambda n: n.tag == "li" and n.inside(kind) and not n.inside(*OUTSIDE) and len(n.text()) >= LEAST_ITEM

    places = [*map(items_of, SENSE), *map(items_of_list, ("ol", "ul"))]
    decisive = next((p for p in places if any(map(p, nodes))), None)
    block = next((name for name in SENSE if any(map(of_class(name), nodes))), "")
    rules = [Rule(decisive, item)] if decisive else []
    rules += [Rule(of_class(block), block_definitions, only_first=True), Rule(lambda n: n.tag == "p" and len(n.text()) >= LEAST_PARAGRAPH, lambda t: [t], only_first=True)]
    return by_rules(nodes, rules)


def examples(nodes: list[Node]) -> list[str]:
    """Examples by class, else italics within senses."""

    def italic(n: Node) -> bool:
        if n.tag not in ("i", "em") or not (n.inside("makna") and n.inside("li")):
            return False
        text = EXAMPLE_LABEL.sub("", n.text())
        return len(text) >= LEAST_I if n.tag == "i" else len(text) >= LEAST_EM and " " in text

    unlabelled = lambda t: [clean(EXAMPLE_LABEL.sub("", t))]
    return distinct(by_rules(nodes, (Rule(of_class("contoh"), unlabelled), Rule(italic, unlabelled))))


def variants(nodes: list[Node]) -> list[str]:
    """Nonstandard forms: all that stands in an element of their class, and what follows the phrase in any text."""

    def listed(text: str) -> list[str]:
        return [VARIANT_LABEL.sub("", clean(part)) for part in LIST_MARKS.split(text.partition(":")[2] or text)]

    found = by_rules(nodes, [Rule(of_class(*VARIANT), listed)])
    for text in (part for n in nodes for part in n.parts if isinstance(part, str)):
        several, one = (phrase.search(text) for phrase in VARIANT_PHRASES)
        if several:
            found += LIST_MARKS.split(several[1].partition("\n")[0])
        if one:
            found.append(one[1])
    return distinct([LAST_MARKS.sub("", clean(form)) for form in found])


def slug(word: str) -> str:
    """Lower case, white space to hyphens, only a-z, 0-9, hyphen and underscore; the lowered word if nothing is left."""
    lowered = word.strip().lower()
    return re.sub(r"[^a-z0-9\-_]", "", re.sub(r"\s+", "-", lowered)) or lowered


def parse_html(content: bytes | None, url: str | None) -> tuple:
    """The fields of ENTRY; an error instead of an exception."""
    if not content:
        return None, None, [], [], [], [], "raw_bytes is empty"
    try:
        html = bytes(content).decode()
    except UnicodeDecodeError:
        return None, None, [], [], [], [], "raw_bytes not valid utf-8"
    root = Tree(html).root
    nodes = list(root.walk())
    word, found = headword(nodes, url or ""), senses(nodes)
    error = "lema not found" if not word else None if found else "makna not found"
    return slug(word) or None, word or None, word_classes(nodes, root.text()), found, examples(nodes), variants(nodes), error


def mapped(snapshots: DataFrame, parser: Callable[..., tuple], fields: str, *also: Column) -> DataFrame:
    """raw_snapshot_id and url of ``snapshots`` with the fields that ``parser`` makes of content, url and the columns ``also``.

    A map over batches, which filters and projections behind it neither enter nor repeat.
    """
    names = [f.split()[0] for f in fields.split(", ")]
    kinds = [pa.string() if f.endswith(" string") else pa.list_(pa.string()) for f in fields.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [parser(*row) for row in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True)]
            made = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:1], batch.column("url"), *made], ["raw_snapshot_id", "url", *names])

    rows = snapshots.select("raw_snapshot_id", "content", "url", *(c.alias(f"also{i}") for i, c in enumerate(also)))
    schema = StructType([rows.schema["raw_snapshot_id"], rows.schema["url"], *StructType.fromDDL(fields)])
    return rows.mapInArrow(run, schema)


def html_entries(snapshots: DataFrame, parser: Callable[[bytes, str], tuple] = parse_html) -> DataFrame:
    """``snapshots`` (raw_snapshot_id, content, url) with the fields of ENTRY; any parser of that shape may be given."""
    return mapped(snapshots, parser, ENTRY)


def address(url: Column) -> tuple[Column, Column]:
    """What an address ends in, as ``payloads.parse_json`` takes it."""
    return F.lower(payloads.address_tail(url)), payloads.address_word(url)


def json_entries(snapshots: DataFrame) -> DataFrame:
    """``snapshots`` (raw_snapshot_id, content, url) whose content is JSON, as the fields of WHOLE_ENTRY.

    Of a list, the object whose word ends the address, else the first. An entry without a word gets that of its address.
    """
    return mapped(snapshots, lambda content, url, tail, word: payloads.parse_json(content, tail, word, slug), WHOLE_ENTRY, *address(F.col("url")))


def parse(snapshots: DataFrame) -> DataFrame:
    """JSON if the first character says so and it parses, else HTML."""
    text = F.decode("content", "UTF-8")
    is_json = F.coalesce(text.rlike(r"^\s*[\{\[]") & F.try_parse_json(text).isNotNull(), F.lit(False))

    def one(content: bytes | None, url: str | None, json: bool, tail: str | None, word: str | None) -> tuple:
        return payloads.parse_json(content, tail, word, slug) if json else (*parse_html(content, url), *(None for _ in payloads.OPTIONAL))

    return mapped(snapshots, one, WHOLE_ENTRY, is_json, *address(F.col("url")))


def replay_differences(once: DataFrame, again: DataFrame) -> DataFrame:
    """Rows that one of two parses has and the other hasn't; none if parsing is deterministic."""
    return once.exceptAll(again).unionAll(again.exceptAll(once))
