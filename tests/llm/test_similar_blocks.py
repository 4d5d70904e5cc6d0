"""Pairs come from blocks of fingerprint bits; shingles bring what these leave."""

import random

import numpy as np

from leksika.llm import similar, simhash
from tests.llm.test_simhash import SCHEMA
from tests.llm.test_similar_exact import all_pairs


def copies():
    """Texts of 400 words, each with one that differs in its last word and one that differs in its last fifteen."""
    rng, out = random.Random(8), []
    for k in range(12):
        words = [f"w{rng.randrange(10**7)}" for _ in range(400)]
        out += [" ".join(words), " ".join([*words[:-1], f"end{k}"]), " ".join([*words[:-15], *(f"end{k}x{i}" for i in range(15))])]
    return out


def found_in(spark, given):
    rows = spark.createDataFrame([(i, t, "", "") for i, t in enumerate(given)], SCHEMA).repartition(3)
    return {r.doc_id: r.component_id for r in similar.similar_documents(rows).collect()}


def test_fingerprints_of_up_to_63_differing_bits_share_a_block():
    rng = np.random.default_rng(6)
    base = rng.integers(0, 1 << 63, (50, similar.LIMBS), np.uint64)
    flips = np.zeros((50, similar.SIZE), np.uint8)
    for row in flips:
        row[rng.choice(64, 63, replace=False) * similar.BITS + rng.integers(0, similar.BITS, 63)] = 1
    other = base ^ np.packbits(flips, axis=1, bitorder="little").view("<u8")
    assert ((similar.block_keys(base) == similar.block_keys(other)).sum(axis=1) == 1).all()
    assert similar.block_keys(base, 30).shape == (50, 51)


def test_fingerprint_blocks_find_close_pairs_alone(spark, monkeypatch):
    monkeypatch.setattr(similar, "first_shingles", lambda hashes, *_: hashes[:0])
    given = copies()
    expected = dict(enumerate(all_pairs(given)))
    assert len(set(expected.values())) == 12 and found_in(spark, given) == expected


def test_no_pair_is_lost_beyond_the_blocks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "links_within", lambda spread, most: spread.selectExpr("fp as u", "fp as v"))
    given = copies()
    assert found_in(spark, given) == dict(enumerate(all_pairs(given)))


def test_shingles_are_asked_only_across_near_classes(spark):
    """Three copies share a key, and so do three others; these are near classes, and nothing is compared anew. Without classes all are."""
    rng = np.random.default_rng(7)
    fps = np.repeat(rng.integers(0, 1 << 63, (2, similar.LIMBS), np.uint64), 3, axis=0)
    fps[:, 3] ^= np.arange(6, dtype=np.uint64) % np.uint64(3)
    rows = [(i, int(fp[:1].view(np.int64)[0]), fp.tobytes(), np.array([i // 3], "<i8").tobytes()) for i, fp in enumerate(fps)]
    classes = spark.createDataFrame(rows, "id long, bits long, fp binary, firsts binary")
    near = similar.near_classes(classes)
    expected = {(1, 0), (2, 0), (4, 3), (5, 3)}
    assert {(r.id, r.near) for r in near.collect()} == expected
    assert similar.links(classes, near).isEmpty()
    assert {(r.u, r.v) for r in similar.links(classes, spark.createDataFrame([], near.schema)).collect()} == expected
