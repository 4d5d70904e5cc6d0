import random

import numpy as np
import pytest

from leksika.llm import similar
from tests.llm.test_simhash import SCHEMA


def near_pairs():
    """Short and long texts, each with copies of which some words differ at one end or anywhere."""
    rng, out = random.Random(5), []
    line = " ".join(f"common{i}" for i in range(12))
    for size in (*range(5, 16), 30, 60, 100, 204):
        for k in range(12):
            words = [f"w{rng.randrange(10**7)}" for _ in range(size)]
            other = list(words)
            if k % 3 == 0:
                other += [f"end{k}"] * (1 + k // 3 * size // 40)
            elif k % 3 == 1:
                other = other[: -1 - k // 3 * size // 40]
            for _ in range(size * (k % 5) // 90):
                other[rng.randrange(len(other))] = "new"
            out += [" ".join(w) + (" " + line if size == 100 else "") for w in (words, other)]
    return out


def all_pairs(given):
    sets = []
    for t in given:
        w = t.lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))})
    near = np.array([[5 * len(a & b) >= 4 * len(a | b) for b in sets] for a in sets])
    labels = list(range(len(given)))
    while True:
        low = [min(labels[j] for j in np.flatnonzero(near[i])) for i in range(len(given))]
        if low == labels:
            return labels
        labels = low


@pytest.mark.parametrize("block", [3, 1024])
def test_components_are_those_of_all_pairs(spark, block, monkeypatch):
    monkeypatch.setattr(similar.links, "__defaults__", (similar.SIMILARITY, block))
    monkeypatch.setattr(similar.verified, "__defaults__", (block, similar.PIECE_BYTES))
    given = near_pairs()
    rows = spark.createDataFrame([(i, t, "clash", "clash") for i, t in enumerate(given)], SCHEMA).repartition(3)
    found = {r.doc_id: r.component_id for r in similar.similar_documents(rows).collect()}
    expected = all_pairs(given)
    assert found == dict(enumerate(expected))
    assert 60 < len(given) - len(set(expected)) < 175
