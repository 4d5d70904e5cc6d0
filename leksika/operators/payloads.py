"""JSON payloads to the fields of an entry: rules over what ``json`` reads, one payload at a time.

A field's value is a string, a list or an object (``dict``); of others, null among them, no rule makes anything. Members keep
the order in which they stand. ``first_of`` is the same choice of a name as a column.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from leksika.functions.text import capitalised, clean_text

# The names of each field in order of precedence, of what an object within a field says, and of what it wraps.
WORD = ("lema", "kata", "headword", "word", "lemma", "entry", "title")
FIELDS = {
    "makna": ("makna", "arti", "definisi", "definitions", "meanings", "senses", "definition", "sense"),
    "contoh": ("contoh", "examples", "example", "kalimat", "contohKalimat", "sentences"),
    "bentuk_tidak_baku": ("bentukTidakBaku", "bentuk_tidak_baku", "tidakBaku", "varian", "nonstandard", "variant", "bentukTidakBakuList"),
    "kelas_kata": ("kelasKata", "kelas_kata", "kelas", "pos", "wordClass", "word_class"),
    "bentuk_baku": ("bentukBaku", "bentuk_baku", "standardForm", "baku"),
    "etimologi": ("etimologi", "etymology"),
}
SENSE_SAYS = ("definisi", "makna", "arti", "sense", "definition", "description")
SENSE_ITEM_SAYS = (*SENSE_SAYS, "text")
SENSE_ANY_CASE = ("definisi", "makna", "arti", "sense", "definition")
SENSE_WRAPS = ("makna", "meanings", "definitions", "arti", "senses")
EXAMPLE_SAYS, EXAMPLE_WRAPS = ("contoh", "kalimat", "example", "sentence", "text"), ("contoh", "examples", "kalimat")
VARIANT_SAYS, VARIANT_WRAPS = ("bentukTidakBaku", "tidakBaku", "varian", "kata", "lema"), ("bentukTidakBaku", "bentuk_tidak_baku", "tidakBaku", "varian")

#: What only JSON can say of an entry.
OPTIONAL = ("bentuk_baku", "etimologi")

#: Objects that may wrap a field's value in one another; a value that lies deeper is none.
WRAPS = 3


LISTED, CLASSES = re.compile("[,;]"), re.compile(r"[,;/\s]+")
LAST_MARKS, EXAMPLE_LABEL = re.compile("[.;:]+$"), re.compile(r"(?i)^contoh\s*:\s*")
#: Numbers are never texts, so they are read as nothing, however long.
READER = json.JSONDecoder(parse_int=lambda _: 0, parse_float=lambda _: 0, parse_constant=lambda _: 0)


def first_of(payload: Column, names: tuple[str, ...]) -> Column:
    """The text of what ``picked`` picks from an object's JSON, as a column; JSON of what is nested."""
    listed, found = F.split(F.lit(",".join(names)), ","), F.from_json(payload, "map<string,string>")
    exact = F.filter(listed, lambda n: F.map_contains_key(found, n))
    folded = F.transform(listed, lambda n: F.try_element_at(F.filter(F.map_entries(found), lambda e: F.lower(e["key"]) == F.lower(n)), F.lit(-1)))
    other = F.get(F.filter(folded, lambda e: e.isNotNull()), F.lit(0))["value"]
    return F.when(F.size(exact) > 0, F.try_element_at(found, F.get(exact, F.lit(0)))).otherwise(other)


def address_tail(url: Column) -> Column:
    return F.substring_index(F.regexp_replace(url, "/+$", ""), "/", -1)


def address_word(url: Column) -> Column:
    """the word that an address ends in, capitalised if it is all lower case; null if there is none."""
    tail = address_tail(url)
    decoded = clean_text(F.coalesce(F.try_url_decode(F.replace(tail, F.lit("+"), F.lit("%2B"))), tail))
    return F.nullif(capitalised(decoded), F.lit(""))


def clean(text: str) -> str:
    """F01; what is no character (half a surrogate pair) is a question mark."""
    return " ".join(re.sub("[\u200b\u200c\u200d\ufeff]", "", text.encode("utf-8", "replace").decode()).split())


def distinct(items: list[str]) -> list[str]:
    """A18."""
    return list(dict.fromkeys(i for i in map(str.strip, items) if i))


def picked(found: dict, names: tuple[str, ...]) -> object:
    """The value of the first name that is a member (none if it holds null), exactly, else in any case (the last of its spellings)."""
    for name in names:
        if name in found:
            return found[name]
    folded = {k.lower(): v for k, v in found.items()}
    return next((folded[n.lower()] for n in names if n.lower() in folded), None)


def string(value: object) -> str | None:
    """The cleaned text of a value that is a string."""
    return clean(value) if isinstance(value, str) else None


def said(found: dict, names: tuple[str, ...], empty: bool = True) -> str | None:
    """The cleaned text of the first of some members that is a string; with ``empty`` false, of the first with text."""
    told = (string(found.get(n)) for n in names)
    return next((t for t in told if (t is not None if empty else t)), None)


def texts(text: str | None) -> list[str]:
    return [text] if text else []


def unwrapped(value: object, wraps: tuple[str, ...], says: tuple[str, ...] = ()) -> object:
    """What an object that says nothing itself holds under the first of some names, up to ``WRAPS`` times over."""
    for _ in range(WRAPS):
        under = next((n for n in wraps if n in value), None) if isinstance(value, dict) else None
        if under is None or said(value, says, empty=False):
            return value
        value = value[under]
    return value


def by_kind(value: object, string_: Callable[[str], list[str]], list_: Callable[[list], list[str]], object_: Callable[[dict], list[str]] | None = None) -> list[str]:
    """A field's texts by the kind of its value; none for what has no rule."""
    if isinstance(value, str):
        return string_(clean(value))
    if isinstance(value, list):
        return list_(value)
    return object_(value) if object_ and isinstance(value, dict) else []


def of_items(found: list, text: Callable[[str], str], object_: Callable[[dict], str | None] | None = None) -> list[str]:
    """The texts of a list's strings and objects, empty ones left out; other values are ignored."""
    made = (text(clean(v)) if isinstance(v, str) else object_(v) if object_ and isinstance(v, dict) else None for v in found)
    return [t for t in made if t]


def sense_of(found: dict) -> str | None:
    """What an object in a list of senses says: by its name, by one in any case, else its first string that isn't blank."""
    strings = [(k, v) for k, v in found.items() if isinstance(v, str)]
    named = said(found, SENSE_ITEM_SAYS[:1])
    if named is None:
        odd = next((v for k, v in strings if k.lower() in SENSE_ANY_CASE), "")
        named = clean(odd) or said(found, SENSE_ITEM_SAYS[1:])
    return named or next((clean(v) for _, v in strings if v.strip()), None)


def senses(value: object) -> list[str]:
    """A string, an object or a list of both as definitions, repeats included."""
    return by_kind(unwrapped(value, SENSE_WRAPS, SENSE_SAYS), texts, lambda v: of_items(v, lambda t: t, sense_of), lambda m: texts(said(m, SENSE_SAYS, empty=False)))


def examples(value: object) -> list[str]:
    """X11: a string, a list of strings and objects, or an object that wraps one."""
    listed = lambda v: distinct(of_items(v, lambda t: EXAMPLE_LABEL.sub("", t), lambda m: said(m, EXAMPLE_SAYS)))
    return by_kind(unwrapped(value, EXAMPLE_WRAPS), texts, listed)


def variants(value: object) -> list[str]:
    """X11: a string is parted at commas and semicolons, the strings of a list are not."""
    bare = lambda t: LAST_MARKS.sub("", t).strip()
    listed = lambda v: distinct(of_items(v, bare, lambda m: said(m, VARIANT_SAYS)))
    return by_kind(unwrapped(value, VARIANT_WRAPS), lambda t: distinct([bare(clean(part)) for part in LISTED.split(t)]), listed)


def word_classes(value: object) -> list[str]:
    """X11: lower case, without points around them; a string is parted at commas, semicolons, slashes and spaces."""
    bare = lambda t: t.lower().strip(" .")
    return by_kind(value, lambda t: distinct([bare(part) for part in CLASSES.split(t)]), lambda v: distinct(of_items(v, bare)))


def chosen(payload: object, tail: str | None) -> dict | None:
    """An object itself; of a list the first object whose word is the end of the address (``tail``, in lower case), else the first object."""
    if not isinstance(payload, list):
        return payload if isinstance(payload, dict) else None
    objects = [v for v in payload if isinstance(v, dict)]
    words = (picked(v, WORD[:-1]) for v in objects)
    same = (v for v, w in zip(objects, words, strict=True) if isinstance(w, str) and w.strip().lower() == tail)
    return next(same, objects[0] if objects else None)


def parse_json(content: bytes | None, tail: str | None, word: str | None, key: Callable[[str], str]) -> tuple:
    """The fields of an entry, its error, and what only JSON can say of one.

    ``tail`` and ``word`` are what the address ends in, in lower case and as a word; ``key`` makes the id of a word.
    """
    try:
        text = bytes(content or b"").decode().strip()
        payload, end = READER.raw_decode(text)
    except (ValueError, RecursionError):
        text, payload, end = "", None, 0
    found = chosen(payload, tail)
    if found is None:
        return None, None, [], [], [], [], "JSON payload is empty list" if payload == [] and end == len(text) else "JSON list contains no object", None, None
    lema = string(picked(found, WORD)) or word
    field = {name: picked(found, names) for name, names in FIELDS.items()}
    makna = senses(field["makna"])
    error = "lema not found" if lema is None else None if makna else "makna not found"
    optional = (string(field[name]) or None for name in OPTIONAL)
    return key(lema) if lema else None, lema, word_classes(field["kelas_kata"]), makna, examples(field["contoh"]), variants(field["bentuk_tidak_baku"]), error, *optional
