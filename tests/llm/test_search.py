"""Exact and approximate search against brute force."""

import math
import random
from fractions import Fraction

import numpy as np
import pyarrow.compute as pc
import pytest

from leksika.llm import additive, topk
from leksika.llm.common import table
from leksika.llm.vectors import Best, Distinct


def brute(rows, every, k, score):
    """query_id -> [(vec_id, score)]: distinct ids, the best score of each, ties to the smaller id."""
    out = {}
    for q_id, q in rows:
        if q_id is not None and q_id % every == 0:
            have = out.setdefault(q_id, {})
            for x_id, x in rows:
                if x_id != q_id:
                    have[x_id] = max(have.get(x_id, -math.inf), score(q, x))
    return {q: sorted(h.items(), key=lambda p: (-p[1], p[0]))[:k] for q, h in out.items()}


def answers(df):
    found = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(found[r.query_id])
    return found


def whole(q, x):
    return sum(math.floor(256 * Fraction(a)) * math.floor(256 * Fraction(b)) for a, b in zip(q, x, strict=False))


def usable(rows, zero=True):
    return [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and (zero or any(v))]


def random_rows(seed, n=160, dims=7):
    rng = random.Random(seed)
    rows = [(rng.randrange(n) if rng.random() < 0.2 else i, [rng.choice((0.0, 0.25, rng.uniform(-1, 1))) for _ in range(dims)]) for i in range(n)]
    rows += [(n + i, rows[0][1]) for i in range(60)]  # one very common vector
    rows += [(None, [1.0] * dims), (7, None), (50, [None] + [1.0] * (dims - 1)), (100, [float("nan")] * dims), (150, [float("inf")] * dims), (400, [0.0] * dims), (1000, [1.0, 2.0]), (1001, []), rows[3], rows[3]]
    rng.shuffle(rows)
    return rows


SCHEMA = "vec_id long, embedding array<double>, query_id int, rank string, score string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", "y") for i, v in rows], SCHEMA)


@pytest.mark.parametrize("seed", [1, 2])
def test_top_k_is_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr("leksika.llm.vectors.CANDIDATE_BLOCK", 64)
    monkeypatch.setattr("leksika.llm.vectors.QUERY_BLOCK", 3)
    monkeypatch.setattr("leksika.llm.topk.STEP", 2)
    monkeypatch.setattr("leksika.llm.topk.PROMISING", 2 + seed)
    monkeypatch.setattr("leksika.llm.topk.DENSE", seed - 1.5)  # a matrix for all, and pairs only
    rows = random_rows(seed)
    assert answers(topk.top_k(frame(spark, rows))) == brute(usable(rows), 50, 5, whole)


def test_top_k_of_huge_components_is_exact(spark):
    rows = [(0, [2.0**20, 3.0]), (1, [2.0**20, -1.0]), (2, [2.0**20 + 1, 0.0]), (3, [1e300, 0.0])]
    found = answers(topk.top_k(frame(spark, rows)))
    assert found[0] == [(3, 2**63 - 1), (2, whole(rows[0][1], rows[2][1])), (1, whole(rows[0][1], rows[1][1]))]


def test_bounds_hold():
    rng = np.random.default_rng(3)
    q, x = rng.normal(size=(20, 64)), rng.normal(size=(30, 64))
    exact = ((q[:, None] - x[None]) ** 2).sum(axis=2)
    last = -np.inf
    for segments in (1, 4, 16):
        low = topk.lower_bounds(topk.statistics(q, segments), topk.statistics(x, segments), (q * q).sum(axis=1), (x * x).sum(axis=1))
        assert (low <= exact + 1e-9).all()
        assert low.mean() >= last
        last = low.mean()


@pytest.mark.parametrize("dense", [0.5, 2.0])
def test_bounds_save_products(monkeypatch, dense):
    """On clustered rows less than a fifth of the pairs is multiplied, and the result is that of all."""
    monkeypatch.setattr("leksika.llm.topk.DENSE", dense)
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(64, 64))
    x = np.floor(256 * (centres[rng.integers(0, 64, 6000)] + 0.15 * rng.normal(size=(6000, 64))))
    q, ids = x[::50], np.arange(0, 6000, 50)
    have, held = Distinct.of(np.arange(6000), x, 6)[0], Best(5, np.int64)
    assert topk.search_block(ids, q, have, held) < 0.2 * len(q) * len(x)
    found = held.table()
    exact = q @ x.T
    exact[np.arange(len(q)), ids] = -np.inf
    for n, query in enumerate(ids):
        mine = found.filter(pc.equal(found.column("query_id"), int(query)))
        order = np.lexsort((np.arange(6000), -exact[n]))[:5]
        assert mine.column("vec_id").to_pylist() == order.tolist() and mine.column("score").to_pylist() == exact[n][order].astype(int).tolist()


def test_empty_tables(spark):
    assert topk.top_k(frame(spark, [])).count() == 0
    assert additive.nearest(frame(spark, [])).count() == 0
    assert topk.top_k(frame(spark, [(50, [1.0])])).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_small_approximate_search_is_exact(spark, monkeypatch, seed):
    monkeypatch.setattr("leksika.llm.vectors.CANDIDATE_BLOCK", 64)
    rows = random_rows(seed)
    found = answers(additive.nearest(frame(spark, rows)))
    expected = brute(usable(rows, zero=False), 20, 20, lambda q, x: sum(a * b for a, b in zip(q, x, strict=False)))
    assert found.keys() == expected.keys()
    for q, best in expected.items():
        assert [s for _, s in found[q]] == pytest.approx([s for _, s in best])


def test_recall(spark, sf, monkeypatch):
    """Against brute force, with so short a reranking that the codes decide."""
    rows = [(r.vec_id, np.array(r.embedding)) for r in table(spark, sf, "embeddings").collect()]
    ids, x = np.array([i for i, _ in rows]), np.stack([v for _, v in rows])
    from pyspark.sql import functions as F

    from leksika.llm.vectors import usable as usable_rows

    vectors = usable_rows(table(spark, sf, "embeddings"), "vec_id", "embedding", zero=False)
    books = additive.train(vectors)
    found = answers(additive.search(vectors.where(F.col("id") % 20 == 0), additive.index(vectors, books), books, rerank=60))
    hits = []
    for q in ids[ids % 20 == 0]:
        s = x @ x[ids == q][0]
        s[ids == q] = -np.inf
        hits.append(len({i for i, _ in found[q]} & set(ids[np.argsort(-s)[:20]].tolist())) / 20)
    assert np.mean(hits) >= 0.9


def test_a_vector_wider_than_the_others(spark):
    """Components beyond the codebooks' width count in the reranking; wide rows and narrow ones meet on zeros."""
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(60)] + [(60, rng.normal(size=5000).tolist()), (61, [0.0] * 4000 + [1.0])]
    found = answers(additive.nearest(frame(spark, rows)))
    expected = brute(usable(rows, zero=False), 20, 20, lambda q, x: sum(a * b for a, b in zip(q, x, strict=False)))
    for q, best in expected.items():
        assert [i for i, _ in found[q]] == [i for i, _ in best] and [s for _, s in found[q]] == pytest.approx([s for _, s in best])


def test_packed_rows_are_exact():
    x = np.array([[0.5, -0.0, 0.0], [0.1, 2.0, 0.0], [0.0, 0.0, 0.0], [1e300, 1.0, 3.0], [np.float64(np.float32(0.1)), 0.0, 1e-40]])
    back = additive.unpacked(additive.packed(x))
    assert (back == x).all()


def test_beam_is_no_worse_than_greedy():
    rng = np.random.default_rng(5)
    x = additive.directions(rng.normal(size=(400, 16)))
    books = additive.fit_books(x, books=4, words=16)
    error = lambda beam: ((x - additive.decode(additive.encode(x, books, beam), books)) ** 2).sum()
    assert error(8) <= error(1) + 1e-6


def test_ids_beyond_doubles_stay_apart(spark):
    big = 1 << 61
    rows = [(50 * (big // 50), [1.0]), (50 * (big // 50) + 50, [1.0]), (1, [2.0])]
    found = answers(topk.top_k(frame(spark, rows)))
    assert {q: [i for i, _ in best] for q, best in found.items()} == {rows[0][0]: [1, rows[1][0]], rows[1][0]: [1, rows[0][0]]}
