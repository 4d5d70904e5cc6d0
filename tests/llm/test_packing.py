import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from leksika.llm import packing
from leksika.llm.common import Words

SCHEMA = "doc_id long, text string, length string, task int"


def optimum(items, size):
    best = [len(items)]
    items = sorted(items, reverse=True)

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for b in {x: k for k, x in enumerate(bins)}.values():
            if bins[b] + items[i] <= size:
                bins[b] += items[i]
                place(i + 1, bins)
                bins[b] -= items[i]
        place(i + 1, [*bins, items[i]])

    place(0, [])
    return best[0]


@settings(max_examples=150, deadline=None)
@given(st.integers(8, 30).flatmap(lambda size: st.tuples(st.just(size), st.lists(st.integers(1, size), min_size=1, max_size=9))))
def test_reduction_keeps_the_optimum(case):
    size, items = case
    counts = np.bincount(items, minlength=size + 1).astype(np.int64)
    plan = packing.Plan(size)
    packing.reduce_instance(counts, plan)
    rest = [w for w in range(size + 1) for _ in range(counts[w])]
    assert plan.sequences + optimum(rest, size) == optimum(items, size)
    whole = packing.plan_histogram(Counter(items), size)
    placed = Counter()
    for count, parts in whole.kinds:
        assert sum(w * n for w, n in parts) <= size
        for w, n in parts:
            placed[w] += n * count
    assert placed == Counter(items)
    assert whole.sequences <= 11 * optimum(items, size) / 9 + 1


def texts():
    rng = random.Random(5)
    words = ["the", "Über", "naïve", "x1,", "end.", "'s", "<|endoftext|>", "日本", "a b", "İstanbul", "don't", "é"]
    out = [" ".join(rng.choice(words) for _ in range(rng.choice((0, 1, 5, 40, 300)))) for _ in range(60)]
    return [*out, None, "", " \n ", "word " * 9000, "same text", "same text"]


def test_ids_are_those_of_whole_texts():
    encoder, _ = packing.tokenizer(packing.TOKENIZER)
    given_texts = texts()
    for text, ids in zip(given_texts, packing.token_ids(pa.array(given_texts, pa.string())), strict=True):
        assert ids.tolist() == encoder.encode(text or "", add_special_tokens=False).ids + [1]


def test_words_are_those_of_bytes():
    rng = random.Random(2)
    for _ in range(100):
        column = [None if rng.random() < 0.1 else "".join(rng.choice("aB é\t\n\x0b\x0c\x85\xa0ñ") for _ in range(rng.randrange(12))) for _ in range(rng.randrange(6))]
        words = Words(pa.array([*column, "tail"], pa.string()).slice(0, len(column)), lower=True)
        have = words.distinct.to_pylist()
        assert [[have[c] for c in words.codes[s:e]] for s, e in zip(words.starts, words.ends, strict=True)] == [(t or "").encode().lower().split() for t in column]


@pytest.mark.parametrize("size", [64, 4096])
def test_pieces_and_places(spark, size):
    rows = [(None if i == 3 else i % 50, t, "x", 1) for i, t in enumerate(texts())]
    found = packing.pack(spark.createDataFrame(rows, SCHEMA).repartition(5), size).collect()
    encoder, _ = packing.tokenizer(packing.TOKENIZER)
    expected = Counter()
    for doc_id, text, *_ in rows:
        ids = encoder.encode(text or "", add_special_tokens=False).ids + [1]
        for k, start in enumerate(range(0, len(ids), size)):
            own = np.array(ids[start : start + size], "<u4")
            expected[doc_id, k, start, len(own), zlib.crc32(own.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == expected
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size


def test_as_few_sequences_as_tokens_allow(spark, sf):
    found = packing.pack(spark.read.parquet(f"{sf}/documents.parquet")).selectExpr("sum(length) as tokens", "count(distinct sequence_id) as n").first()
    assert found.n <= -(-found.tokens // 4096) + 1


def test_empty(spark):
    assert packing.pack(spark.createDataFrame([], SCHEMA)).count() == 0
