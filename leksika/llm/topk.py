"""Exact top-k search by multi-resolution segment statistics.

A vector is cut into 1, 4, then 16 segments; a segment is told by its mean and deviation. With l the
segment's length, the squared distance of two vectors is at least the sum over segments of
l * ((difference of means)^2 + (difference of deviations)^2), and by |q|^2 + |x|^2 - 2 q.x that bounds
their inner product from above. Bounds go coarse to fine. At each resolution a query's few most promising
rows are multiplied, which raises its k-th best so far, and only pairs whose bound reaches that go on: pair by
pair, not by rows and columns. The survivors of the finest are multiplied, in whole numbers.

Defined results: vectors that are null or hold a null or non-finite component take no part, nor do rows
with a null id; an empty vector is a vector of zeros, and the shorter of two vectors ends in zeros; ties
go to the smaller id; rows that repeat an id count as one candidate and one query, with the best score;
scores beyond 64 bits stop at the limits; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leksika.llm.vectors import Best, Distinct, against_all, matrix, usable, widen

SCALE, QUERIES_AT, K = 256.0, 50, 5
SEGMENTS = (1, 4, 16)
#: Queries that are bounded against a block at once; rows that each multiplies at a resolution to learn its reach.
STEP, PROMISING = 64, 24
#: Above this share of pairs left, a whole matrix is computed faster than single pairs.
DENSE = 0.5

def statistics(rows: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations times the root of the segment's length: their inner products are upper bounds."""
    width = -(-rows.shape[1] // segments) * segments
    cut = widen(rows, width).reshape(len(rows), segments, -1)
    root = np.sqrt(cut.shape[2])
    return np.concatenate((cut.mean(axis=2) * root, cut.std(axis=2) * root), axis=1)


def lower_bounds(q: np.ndarray, x: np.ndarray, q_square: np.ndarray, x_square: np.ndarray) -> np.ndarray:
    """Squared distances at least this, from statistics of one resolution."""
    return q_square[:, None] + x_square[None, :] - 2 * (q @ x.T)


def whole_products(q: np.ndarray, x: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Exact inner products of the pairs of rows ``i`` of ``q`` and ``j`` of ``x``, of whole numbers."""
    out = np.empty(len(i), np.int64)
    if q.shape[1] * float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) < 2.0**53:
        for at in range(0, len(i), 1 << 16):
            out[at : at + (1 << 16)] = np.einsum("nd,nd->n", q[i[at : at + (1 << 16)]], x[j[at : at + (1 << 16)]])
        return out
    for n, (a, b) in enumerate(zip(i.tolist(), j.tolist(), strict=True)):
        out[n] = max(-(1 << 63), min((1 << 63) - 1, sum(int(v) * int(w) for v, w in zip(q[a].tolist(), x[b].tolist(), strict=True))))
    return out


def search_block(query_ids: np.ndarray, q: np.ndarray, have: Distinct, held: Best) -> int:
    """Add to ``held`` the pairs of a block that can be among each query's best, and return how many pairs were multiplied."""
    products = 0
    for at in range(0, len(q), STEP):
        mine = query_ids[at : at + STEP]
        i, j, s, multiplied = search_group(mine, q[at : at + STEP], have, held.k, held.reach(mine))
        held.add(mine, i, j, s, have)
        products += multiplied
    return products


def search_group(query_ids: np.ndarray, q: np.ndarray, have: Distinct, k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Pairs (query, distinct row, score) that hold each query's ``k`` best of a block besides its own id, as far as they reach its ``floor``."""
    x = have.rows
    n, rows = len(q), len(x)
    with np.errstate(over="ignore", invalid="ignore"):
        q_square, x_square = (q * q).sum(axis=1), (x * x).sum(axis=1)
        slack = 1e-6 + 1e-9 * (q_square[:, None] + x_square[None, :])
    alive, done = np.ones((n, rows), bool), np.zeros((n, rows), bool)
    reach = floor.copy()  # the k-th best of others so far
    kept, products = [np.empty(0, np.int64)] * 3, 0

    def multiply(i: np.ndarray, j: np.ndarray) -> None:
        """Multiply pairs, keep each query's best and raise its reach."""
        nonlocal kept, products
        done[i, j] = True
        products += len(i)
        kept = [np.concatenate(c) for c in zip(kept, (i, j, whole_products(q, x, i, j)), strict=True)]
        order = np.lexsort((have.least[kept[1]], -kept[2], kept[0]))
        kept = [a[order] for a in kept]
        place = np.arange(len(order)) - np.searchsorted(kept[0], kept[0])
        kept = [a[place <= k] for a in kept]
        other = have.least[kept[1]] != query_ids[kept[0]]
        mine, values = kept[0][other], kept[2][other]
        place = np.arange(len(mine)) - np.searchsorted(mine, mine)
        reach[mine[place == k - 1]] = np.maximum(reach[mine[place == k - 1]], values[place == k - 1])

    for segments in (s for s in SEGMENTS if s < x.shape[1]):
        with np.errstate(over="ignore", invalid="ignore"):
            a, b = statistics(q, segments), statistics(x, segments)
            if alive.sum() > DENSE * alive.size:
                bound = (q_square[:, None] + x_square[None, :] - lower_bounds(a, b, q_square, x_square)) / 2 + slack
            else:
                i, j = np.nonzero(alive)
                bound = np.full((n, rows), -np.inf)
                for at in range(0, len(i), 1 << 16):
                    r, c = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
                    bound[r, c] = np.einsum("nd,nd->n", a[r], b[c]) + slack[r, c]
        bound[np.isnan(bound)] = np.inf  # a bound that overflows prunes nothing
        bound[~alive | done] = -np.inf
        most = min(PROMISING, rows)
        first = np.argpartition(bound, rows - most, axis=1)[:, rows - most :]
        i, j = np.repeat(np.arange(n), most), first.ravel()
        worth = bound[i, j] > -np.inf
        multiply(i[worth], j[worth])
        alive &= ~(bound < reach[:, None])
    i, j = np.nonzero(alive & ~done)
    if len(i) > DENSE * alive.size and x.shape[1] * float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) < 2.0**53:
        # Few pairs were pruned: one matrix product, then the pairs that can still count.
        scores = q @ x.T
        products += n * rows - int(done.sum())
        if rows > k + 1:
            reach = np.maximum(reach, np.partition(scores, rows - k - 2, axis=1)[:, rows - k - 2])
        i, j = np.nonzero((scores >= reach[:, None]) & ~done)
        kept = [np.concatenate(c) for c in zip(kept, (i, j, scores[i, j].astype(np.int64)), strict=True)]
    else:
        for at in range(0, len(i), 1 << 20):
            multiply(i[at : at + (1 << 20)], j[at : at + (1 << 20)])
    return kept[0], kept[1], kept[2], products


#: A floor that two bytes hold; vectors of such floors travel as two-byte numbers.
SMALL = 1 << 15


def floors(df: DataFrame, scale: float) -> DataFrame:
    """id, small (two-byte floors, or null), vec (doubles where a floor is larger, else null)."""
    floor = F.transform("vec", lambda v: F.floor(v * scale))
    fits = F.forall("vec", lambda v: (v * scale >= -SMALL) & (v * scale < SMALL))
    return df.select("id", F.when(fits, floor.cast("array<smallint>")).alias("small"), F.when(~fits, F.col("vec")).alias("vec"))


def whole_rows(table: pa.Table, scale: float) -> np.ndarray:
    """The floors of each row."""
    small, large = (table.column(c).combine_chunks() for c in ("small", "vec"))
    is_small = small.is_valid().to_numpy(zero_copy_only=False)
    a, b = matrix(small.drop_null()), np.floor(scale * matrix(large.drop_null()))
    out = np.zeros((len(is_small), max(a.shape[1], b.shape[1], 1)))
    out[np.flatnonzero(is_small), : a.shape[1]] = a
    out[np.flatnonzero(~is_small), : b.shape[1]] = b
    return out


def top_k(vectors: DataFrame, queries: DataFrame | None = None, k: int = K, scale: float = SCALE, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``k`` largest inner products of floor(scale * component)."""

    def prepare(table: pa.Table) -> pa.Table:
        return Distinct.of(table.column("id").to_numpy(), whole_rows(table, scale), k + 1)[0].table(np.int16)

    def answer(left: pa.Table, blocks: Iterator[pa.Table]) -> Best:
        q, held = whole_rows(left, scale), Best(k, np.int64)
        asked = np.array(sorted({(i, v.tobytes()): n for n, (i, v) in enumerate(zip(left.column("id").to_pylist(), q, strict=True))}.values()))
        query_ids, q = left.column("id").to_numpy()[asked], q[asked]
        for block in blocks:
            have = Distinct.read(block)
            width = max(q.shape[1], have.rows.shape[1])
            have.rows = widen(have.rows, width)
            search_block(query_ids, widen(q, width), have, held)
        return held

    candidates = usable(vectors, id_col, vec_col)
    asked = usable(queries if queries is not None else vectors.where(F.col(id_col) % QUERIES_AT == 0), id_col, vec_col)
    return against_all(floors(asked, scale), floors(candidates, scale), prepare, answer, "long", k)


SQL = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE:g} * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, x.vec_id AS vec_id,
         CAST(list_dot_product(CAST(q.e AS DOUBLE[]), CAST(x.e AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v x ON q.vec_id <> x.vec_id WHERE q.vec_id % {QUERIES_AT} = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {K}
"""
