import random
import string

import numpy as np
import pytest
import xxhash

from pyspark.sql import functions as F

from leksika.llm import similar, simhash

SCHEMA = "doc_id long, text string, fp string, component_id string"


def brute_fingerprint(text, words):
    tokens = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    if not tokens:
        return 0
    shingles = [" ".join(tokens[i : i + words]) for i in range(max(1, len(tokens) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fps, bits=3):
    labels = list(range(len(fps)))

    def root(i):
        while labels[i] != i:
            labels[i] = labels[labels[i]]
            i = labels[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                labels[root(i)] = root(j)
    return [root(i) for i in range(len(fps))]


def texts(n=120):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice(string.ascii_letters + "éß") for _ in range(rng.randint(1, 5)))
    out = [" ".join(word() for _ in range(rng.choice((1, 2, 3, 60, 400)))) for _ in range(n)]
    for i in range(40):
        base = out[rng.randrange(n)].split()
        base[rng.randrange(len(base))] = word()
        out.append(" ".join(base))
    return [*out, None, "", " \n\t", out[0], out[0], out[0].upper(), "x " * 20000, "one", "ONE"]


def test_fingerprints_and_components(spark):
    given = texts()
    rows = [(None if i == 5 else 1000 - i, t, "clash", "clash") for i, t in enumerate(given)]
    found = simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    fps = [brute_fingerprint(t, 3) for t in given]
    groups = components(fps)
    least = {}
    for (i, *_), g in zip(rows, groups, strict=True):
        if i is not None:
            least[g] = min(least.get(g, i), i)
    expected = sorted((str(i), f"{f:016x}", least[g]) for (i, *_), f, g in zip(rows, fps, groups, strict=True) if g in least)
    got = sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in found if r.component_id is not None)
    assert got == expected
    assert len(found) == len(rows)


@pytest.mark.parametrize("block", [3, 16, 1024])
def test_large_buckets_lose_no_link(spark, block):
    rng = random.Random(block)
    fps = set()
    for _ in range(12):
        at = rng.getrandbits(64)
        for _ in range(25):
            fps.add(at)
            at ^= 1 << rng.randrange(64) | 1 << rng.randrange(64) | (1 << rng.randrange(64) if rng.random() < 0.5 else 0)
    fps = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    classes = spark.createDataFrame([(f,) for f in fps], "fp long").repartition(3)
    labels = dict(simhash.connect(simhash.links(classes, 3, block)).collect())
    groups = components([f & (1 << 64) - 1 for f in fps])
    least = {g: min(f for f, h in zip(fps, groups, strict=True) if h == g) for g in groups}
    assert [labels.get(f, f) for f in fps] == [least[g] for g in groups]


def test_every_close_pair_shares_a_block():
    rng = np.random.default_rng(1)
    masks = simhash.block_masks()
    assert len(masks) == 20
    for _ in range(2000):
        flips = 0
        for b in rng.choice(64, 3, replace=False):
            flips |= 1 << int(b)
        assert any((m & (1 << 64) - 1) & flips == 0 for m in masks)


def test_chains_and_stars_connect(spark):
    chain = [(i, i + 1) for i in range(100)] + [(200, 200 + i) for i in range(1, 60)] + [(500, 501), (501, 500), (502, 502)]
    found = dict(simhash.connect(spark.createDataFrame(chain, "u long, v long")).collect())
    assert found == {**{i: 0 for i in range(1, 101)}, **{200 + i: 200 for i in range(1, 60)}, 501: 500}


def test_one_of_each_class_stays(spark):
    rows = [(4, "a b c d e f", "p", "q"), (2, "a b c d e f", "p", "q"), (2, "a b c d e f", "p", "q"), (9, "other words are here now", "p", "q"), (None, "a b c d e f", "p", "q"), (7, None, "p", "q"), (8, "", "p", "q")]
    kept = simhash.drop_duplicates(spark.createDataFrame(rows, SCHEMA))
    assert kept.columns == ["doc_id", "text", "fp", "component_id"]
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "7", "9", "None"]


def test_rows_of_one_id_with_other_texts_are_told_apart(spark):
    """Two texts of one id are no copies; columns may have any name; only copies of a row go."""
    rows = [(5, "alpha beta gamma", "g"), (5, "quite other words here", "g"), (5, "alpha beta gamma", "g"), (6, "alpha beta gamma", "h"), (8, None, "i"), (8, "", "j"), (8, None, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, place string").withColumn("gone", F.lit(1)).withColumn("c0", F.lit("x")).withColumn("root", F.lit(2)).withColumn("__gone", F.lit(3))
    for kept in (simhash.drop_duplicates(docs), similar.stage(spark, docs, "")):
        assert kept.columns == docs.columns
        assert sorted((r.doc_id, r.text) for r in kept.select("doc_id", "text").collect() if r.text) == [(5, "alpha beta gamma"), (5, "quite other words here")]
        assert kept.where("doc_id = 8").count() == 1


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.drop_duplicates(empty).count() == 0
