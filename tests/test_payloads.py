"""JSON payloads: precedence of names, kinds of values, choice of the object, words from addresses."""

import json

import pytest

from leksika.operators import parsing

FIELDS = ("lema", "makna", "contoh", "bentuk_tidak_baku", "kelas_kata", "bentuk_baku", "etimologi", "error")
NONE = dict(lema="Kata", makna=["m"], contoh=[], bentuk_tidak_baku=[], kelas_kata=[], bentuk_baku=None, etimologi=None, error=None)
BASE = {"lema": "Kata", "makna": "m"}

CASES = {
    # two names of one field: the order of the names decides, an exact one before one in another case
    "two words": ({"lemma": "b", "kata": "a", "makna": "m"}, {"lema": "a"}),
    "exact first": ({"LEMA": "b", "title": "a", "makna": "m"}, {"lema": "a"}),
    "any case": ({"Kata": "a", "MAKNA": "x"}, {"lema": "a", "makna": ["x"]}),
    "two senses": ({"lema": "Kata", "definisi": "b", "arti": "a"}, {"makna": ["a"]}),
    "null decides": ({"lema": "Kata", "makna": None, "arti": "a"}, {"makna": [], "error": "makna not found"}),
    "two variants": ({**BASE, "varian": "b", "tidakBaku": "a"}, {"bentuk_tidak_baku": ["a"]}),
    # senses
    "a string that looks like a list": ({"lema": "Kata", "makna": '["x"]'}, {"makna": ['["x"]']}),
    "object": ({"lema": "Kata", "makna": {"definisi": " ", "description": "d"}}, {"makna": ["d"]}),
    "wrapped": ({"lema": "Kata", "makna": {"meanings": [{"text": "t"}, 7, None, "s", "s"]}}, {"makna": ["t", "s", "s"]}),
    "wrapped twice": ({"lema": "Kata", "makna": {"senses": {"arti": {"makna": "deep"}}}}, {"makna": ["deep"]}),
    "odd names": ({"lema": "Kata", "makna": [{"Arti": "x"}, {"catatan": 3, "isi": " y "}, {"definisi": "", "z": "w"}, {"makna": "b", "definisi": "a"}, {}]}, {"makna": ["x", "y", "w", "a"]}),
    "numbers are no senses": ({"lema": "Kata", "makna": 5}, {"makna": [], "error": "makna not found"}),
    # examples, variants, classes
    "examples": ({**BASE, "kalimat": ["Contoh: a", {"sentence": "b"}, "a", {"contoh": "", "text": "c"}, ""]}, {"contoh": ["a", "b"]}),
    "one example": ({**BASE, "sentences": "contoh: a"}, {"contoh": ["contoh: a"]}),
    "wrapped examples": ({**BASE, "contoh": {"examples": ["a"]}}, {"contoh": ["a"]}),
    "variants of a string": ({**BASE, "varian": "a, b; a;, c."}, {"bentuk_tidak_baku": ["a", "b", "c"]}),
    "variants of a list": ({**BASE, "varian": ["a, b;", {"kata": "c"}, "c"]}, {"bentuk_tidak_baku": ["a, b", "c"]}),
    "classes": ({**BASE, "pos": "N, v/adv  n."}, {"kelas_kata": ["n", "v", "adv"]}),
    "classes of a list": ({**BASE, "word_class": ["N.", "kata kerja", 4]}, {"kelas_kata": ["n", "kata kerja"]}),
    # optional fields
    "optional": ({**BASE, "standardForm": " x ", "etymology": "Ar"}, {"bentuk_baku": "x", "etimologi": "Ar"}),
    "optional of other kinds": ({**BASE, "baku": 3, "etimologi": [""]}, {}),
    # the object of a list, and words of addresses
    "list": ([1, {"lema": "lain", "makna": "no"}, {"entry": " JALAN raya ", "makna": "no"}, {"kata": "Jalan%20raya", "makna": "yes"}], {"lema": "Jalan%20raya", "makna": ["yes"]}),
    "first of a list": ([1, {"lema": "lain", "makna": "first"}, {"lema": "lagi", "makna": "no"}], {"lema": "lain", "makna": ["first"]}),
    "word of the address": ({"makna": "m"}, {"lema": "Jalan raya"}),
    "word that is no string": ({"lema": 3, "makna": "m"}, {"lema": "Jalan raya"}),
    "empty list": ([], {"lema": None, "makna": [], "error": "JSON payload is empty list"}),
    "no object": ([1, "x"], {"lema": None, "makna": [], "error": "JSON list contains no object"}),
    "empty object": ({}, {"lema": "Jalan raya", "makna": [], "error": "makna not found"}),
}


@pytest.fixture(scope="module")
def found(spark):
    rows = [(name, json.dumps(payload).encode(), "https://h/entri/jalan%20raya/") for name, (payload, _) in CASES.items()]
    return {r.raw_snapshot_id: r for r in parsing.parse(spark.createDataFrame(rows, "raw_snapshot_id string, content binary, url string")).collect()}


@pytest.mark.parametrize("name", list(CASES))
def test_payload(found, name):
    assert {f: found[name][f] for f in FIELDS} == NONE | CASES[name][1]


def test_no_payload(spark):
    rows = spark.createDataFrame([("a", b'{"makna": "m"}', None), ("b", b'{"makna": "m"}', "")], "raw_snapshot_id string, content binary, url string")
    assert {(r.lema, r.error) for r in parsing.parse(rows).collect()} == {(None, "lema not found")}
