"""Ranked search against brute force in whole numbers, and the bit slices against plain sums."""

import math
import random
import re

import numpy as np
import pytest

from leksika.llm import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, queries, k=10):
    held = [(i, terms(t)) for i, t in docs]
    n_docs, n_terms = sum(bool(t) for _, t in held), sum(len(t) for _, t in held)
    asked = {}
    for i, t in queries:
        if i is not None:
            asked.setdefault(i, set()).update(terms(t))
    df = {}
    for _, t in held:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for item, wanted in asked.items():
        scored = []
        for doc, t in held:
            m, score = 10 + (90 * len(t) * n_docs) // max(1, n_terms), 0
            for x in wanted & set(t):
                tf, w = t.count(x), math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1)))
                score += w * ((10**9 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        out += [(item, r, None if none else doc, -s) for r, (s, none, doc) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def made(seed, n=160):
    rng = random.Random(seed)
    words = ["The", "the", "été", "a1", "straße", "x-y", "10", "日本", "zz", *(f"w{k}" for k in range(60))]
    say = lambda size: rng.choice((" ", ". ", "\n")).join(rng.choices(words, weights=[1 / (1 + j) for j in range(len(words))], k=size))
    docs = [(rng.choice((None, i, i)), say(rng.randrange(1, 30))) for i in range(n)]
    docs += [(n, None), (n + 1, ""), (n + 2, "... --- !"), (n + 3, "the " * 30_000 + "w59"), *docs[:15]]
    docs += [(n + 10 + i, docs[3][1]) for i in range(40)]  # copies tie
    queries = [(i, say(rng.randrange(1, 12))) for i in range(30)] + [(3, "w1 w2"), (None, "the"), (50, None), (51, "nowhere"), (52, "")]
    return docs, queries


def rows(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize(("seed", "block", "queries", "added"), [(1, 8192, 512, 4 << 20), (2, 13, 4, 2000), (3, 64, 512, 1)])
def test_search_is_brute_force(spark, monkeypatch, seed, block, queries, added):
    """One block or many of uneven sizes, one group of queries or many, some at once or one by one."""
    for name, value in (("BLOCK", block), ("QUERIES", queries), ("ADDED", added)):
        monkeypatch.setattr(ranked, name, value)
    docs, asked = made(seed)
    table = spark.createDataFrame([(i, t, 5, "x") for i, t in docs], "doc_id long, text string, block int, term string").repartition(3)
    found = ranked.search(ranked.index(table), spark.createDataFrame([(i, t, "x") for i, t in asked], "item_id long, text string, doc_id string"))
    assert rows(found) == brute(docs, asked)


def test_empty_tables(spark):
    docs, queries = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "the")], "item_id long, text string")
    assert rows(ranked.search(ranked.index(docs), queries)) == []
    some = spark.createDataFrame([(1, "the"), (2, None)], "doc_id long, text string")
    assert rows(ranked.search(ranked.index(some), queries)) == brute([(1, "the"), (2, None)], [(1, "the")])
    assert rows(ranked.search(ranked.index(some), queries.limit(0))) == []


def test_slices_add_and_rank_as_numbers_do():
    rng = np.random.default_rng(4)
    for terms_, docs in ((1, 5), (2, 64), (3, 65), (7, 200), (50, 130)):
        words = -(-docs // 64)
        values = rng.integers(0, 1 << 33, (terms_, docs)) * (rng.random((terms_, docs)) < 0.4)
        maps = np.stack([ranked.sliced(np.flatnonzero(v), v[v > 0], 33, words) for v in values], axis=1)
        sums = ranked.added(maps[:, None])[:, 0]
        bits = np.unpackbits(sums.view(np.uint8).reshape(len(sums), -1), axis=1, bitorder="little")[:, :docs].astype(np.int64)
        total = values.sum(axis=0)
        assert ((bits << np.arange(len(sums))[:, None]).sum(axis=0) == total).all()
        for k in (1, 3, 10):
            best = sorted(sorted(np.flatnonzero(total).tolist(), key=lambda d: (-total[d], d))[:k])
            assert ranked.highest(np.ascontiguousarray(sums), k).tolist() == best


def test_many_ties_take_lower_places():
    same = ranked.sliced(np.arange(500), np.full(500, 12), 5, 8)
    assert ranked.highest(same, 10).tolist() == list(range(10))


def test_terms_in_spark_are_those_of_the_index(spark):
    text = "".join(map(chr, range(1, 0x250))) + " Ünï 日本 ＡＢ  x İI"
    row = spark.createDataFrame([(text,)], "text string").select(ranked.terms_of("text").alias("t")).first()
    assert row.t == terms(text)
