import random

import numpy as np
import pytest

from leksika.llm import similar
from tests.llm.test_simhash import SCHEMA


def texts(n=90):
    rng = random.Random(9)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(3000)]
    base = [" ".join(rng.choice(vocabulary) for _ in range(rng.choice((3, 30, 200, 500)))) for _ in range(n)]
    out = list(base)
    for i in range(70):
        words = base[rng.randrange(n // 3)].split()
        for _ in range(max(1, len(words) * (i % 5) // 200)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        out.append(" ".join(words))
    return [*out, None, "", base[0], base[0].upper(), "x " * 30000]


@pytest.mark.parametrize("block", [4, 1024])
def test_components_are_those_of_verified_pairs(spark, block, monkeypatch):
    monkeypatch.setattr(similar.links, "__defaults__", (similar.SIMILARITY, block))
    given = texts()
    rows = [(None if i == 5 else 1000 - i, t, "clash", "clash") for i, t in enumerate(given)]
    found = {r.doc_id: r.component_id for r in similar.similar_documents(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    fps = np.stack([np.frombuffer(similar.fingerprint((t or "").encode()), "<u8") for t in given])
    bits = np.unpackbits(fps.view(np.uint8), axis=1, bitorder="little")
    keys = np.stack([bits[:, p] @ similar.POWERS for p in similar.PLACES], axis=1)
    near = (similar.distances(fps, fps) <= similar.distance_of(0.8)) & (keys[:, None] == keys[None]).any(axis=2)
    labels = list(range(len(given)))
    for _ in labels:
        labels = [min(labels[j] for j in np.flatnonzero(near[i])) for i in range(len(labels))]
    ids = [i for i, *_ in rows]
    least = {g: min(i for i, h in zip(ids, labels, strict=True) if h == g and i is not None) for g in set(labels)}
    expected = {i: least[g] for i, g in zip(ids, labels, strict=True)}
    assert found == expected
    assert len(set(expected.values())) < len(given) - 40


def shingles(text):
    words = text.split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_recall_and_precision():
    rng = random.Random(3)
    most, found, wrong = similar.distance_of(0.8), [], []
    for _ in range(150):
        words = [str(rng.randrange(10**6)) for _ in range(rng.choice((60, 300)))]
        other = list(words)
        for _ in range(rng.randint(1, max(1, len(words) // 30))):
            other[rng.randrange(len(other))] = "new"
        a, b = " ".join(words), " ".join(other)
        s = len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b))
        f, g = (np.frombuffer(similar.fingerprint(t.encode()), "<u8")[None] for t in (a, b))
        close = similar.distances(f, g)[0, 0] <= most
        if s >= 0.8:
            found.append(close)
        elif s < 0.7:
            wrong.append(close)
    assert np.mean(found) >= 0.9
    assert np.mean(wrong) <= 0.05


def test_a_crowd_is_one_class_and_others_keep_their_links():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, similar.LIMBS, np.uint64)
    most, rows = 240, []
    for k in range(60):
        flip = np.zeros(similar.SIZE, np.uint8)
        flip[rng.choice(similar.SIZE, 150 if k < 40 else 60 * (k - 38), replace=False)] = 1
        rows.append(base ^ np.packbits(flip, bitorder="little").view("<u8"))
    fps, ids = np.stack(rows), np.arange(100, 160)
    u, v = similar.classes_within(ids, fps, most)
    labels = dict(zip(u.tolist(), v.tolist(), strict=True))
    near = similar.distances(fps, fps) <= most
    expect = list(range(60))
    for _ in expect:
        expect = [min(expect[j] for j in np.flatnonzero(near[i])) for i in range(60)]
    assert [labels.get(i, i) for i in ids] == [100 + e for e in expect]


def test_stage_keeps_columns_and_one_of_each(spark):
    rows = [(4, "a b c d e f", "p", "q"), (2, "a b c d e f", "p", "q"), (2, "a b c d e f", "p", "q"), (9, "other words are here now", "p", "q"), (None, "a b c d e f", "p", "q")]
    kept = similar.stage(spark, spark.createDataFrame(rows, SCHEMA), "")
    assert kept.columns == ["doc_id", "text", "fp", "component_id"]
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "9", "None"]
    assert similar.stage(spark, spark.createDataFrame([], SCHEMA), "").count() == 0


