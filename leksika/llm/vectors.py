"""Stated query vectors against all vectors, in blocks: what exact and approximate search share.

Candidates are dealt into blocks of bounded size by row position, whatever their ids, so no id or repeated
vector makes a large group, and written once to the shared folder. Queries are dealt to tasks, which map one
block after another and hold each query's best few so far; the worst of these is what later blocks must reach.
A vector that a block holds many times is scored once and stands for its smallest ids. What moves grows with
the queries, and not with the product of both sides.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leksika.sources.blocks import answered, first_places, write_blocks

#: Queries of a task at most, and rows of a block.
QUERY_BLOCK, CANDIDATE_BLOCK = 4096, 16384


def usable(df: DataFrame, id_col: str, vec_col: str, zero: bool = True) -> DataFrame:
    """id, vec (doubles) of rows whose id is not null and whose vector is finite throughout; not zero, unless ``zero``."""
    vec = F.col(vec_col).cast("array<double>")
    picked = df.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec")).where(F.col("id").isNotNull() & F.col("vec").isNotNull())
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return picked.where(finite if zero else finite & F.exists("vec", lambda x: x != 0))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of doubles; shorter vectors end in zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(sizes) and (sizes == sizes[0]).all():
        return flat.reshape(len(sizes), -1)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))))
    rows = np.repeat(np.arange(len(sizes)), sizes)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def widen(a: np.ndarray, width: int) -> np.ndarray:
    return a if a.shape[1] == width else np.pad(a, ((0, 0), (0, width - a.shape[1])))


class Distinct:
    """The distinct rows of a block, by their smallest id, with up to ``keep`` smallest ids of each."""

    def __init__(self, rows: np.ndarray, at: np.ndarray, ids: np.ndarray):
        self.rows, self.at, self.ids = rows, at, ids
        self.least = ids[at[:-1]]

    @classmethod
    def of(cls, ids: np.ndarray, rows: np.ndarray, keep: int) -> tuple[Distinct, np.ndarray]:
        """And for each distinct row a row of ``rows`` that is equal to it."""
        order = np.argsort(ids, kind="stable")
        ids, rows = ids[order], np.ascontiguousarray(rows[order]) + 0.0  # -0.0 and 0.0 are one
        keys = rows.view(np.dtype((np.void, rows.dtype.itemsize * rows.shape[1]))).ravel() if rows.shape[1] else np.zeros(len(rows), np.int8)
        _, first, of = np.unique(keys, return_index=True, return_inverse=True)
        of = np.argsort(np.argsort(first))[of]
        first = np.sort(first)
        pairs = np.unique(np.stack((of, ids), axis=1), axis=0)
        pairs = pairs[first_places(pairs[:, 0]) < keep]
        return cls(rows[first], np.searchsorted(pairs[:, 0], np.arange(len(first) + 1)), pairs[:, 1]), order[first]

    @classmethod
    def read(cls, block: pa.Table) -> Distinct:
        """From a block's ``row`` and ``ids``."""
        ids, row = (block.column(c).combine_chunks() for c in ("ids", "row"))
        rows = row.flatten().to_numpy(zero_copy_only=False).reshape(len(row), -1)
        return cls(rows.astype(np.float64), np.array(ids.offsets).astype(np.int64), ids.values.to_numpy(zero_copy_only=False))

    def table(self, narrow: type) -> pa.Table:
        """``row`` and ``ids`` of a block; rows as ``narrow`` numbers where these hold them."""
        with np.errstate(over="ignore", invalid="ignore"):
            small = self.rows.astype(narrow)
        flat = (small if (small == self.rows).all() else self.rows).ravel()
        ids = pa.ListArray.from_arrays(pa.array(self.at, pa.int32()), pa.array(self.ids, pa.int64()))
        return pa.table({"row": pa.FixedSizeListArray.from_arrays(pa.array(flat), max(1, self.rows.shape[1])), "ids": ids})


SCORED = ("query_id", "vec_id", "score")


class Best:
    """Each query id's ``k`` best so far: by score and then smaller id, without its own, each id once."""

    def __init__(self, k: int, kind: type):
        self.k, self.q, self.ids, self.s = k, np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, kind)

    def add(self, query_ids: np.ndarray, queries: np.ndarray, found: np.ndarray, scores: np.ndarray, have: Distinct) -> None:
        """``queries``, ``found``, ``scores``: pairs of a query and a distinct row of a block, by number."""
        copies = have.at[found + 1] - have.at[found]
        q = query_ids[np.repeat(queries, copies)]
        ids = have.ids[np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies) + np.repeat(have.at[found], copies)]
        other = q != ids
        q, ids = np.concatenate((self.q, q[other])), np.concatenate((self.ids, ids[other]))
        s = np.concatenate((self.s, np.repeat(scores, copies)[other].astype(self.s.dtype)))
        # An id that stands there twice, by repeated rows, counts once, with its best score. (~x orders whole numbers as -x, without its overflow.)
        falling = ~s if s.dtype.kind == "i" else -s
        order = np.lexsort((falling, ids, q))
        q, ids, s, falling = q[order], ids[order], s[order], falling[order]
        once = np.append(True, (q[1:] != q[:-1]) | (ids[1:] != ids[:-1])) if len(q) else np.empty(0, bool)
        q, ids, s, falling = q[once], ids[once], s[once], falling[once]
        order = np.lexsort((ids, falling, q))
        top = order[first_places(q[order]) < self.k]
        self.q, self.ids, self.s = q[top], ids[top], s[top]

    def reach(self, query_ids: np.ndarray) -> np.ndarray:
        """The k-th best score of each query id so far, minus infinity where there are fewer."""
        last = np.flatnonzero(first_places(self.q) == self.k - 1)
        if not len(last):
            return np.full(len(query_ids), -np.inf)
        at = np.minimum(np.searchsorted(self.q[last], query_ids), len(last) - 1)
        return np.where(self.q[last][at] == query_ids, self.s[last][at].astype(np.float64), -np.inf)

    def table(self) -> pa.Table:
        return pa.table(dict(zip(SCORED, (self.q, self.ids, self.s), strict=True)))


def ranked(scored: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``k`` highest scores, a pair with its best one, ties to the smaller id."""
    merged = scored.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return merged.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def against_all(queries: DataFrame, candidates: DataFrame, prepare: Callable[[pa.Table], pa.Table], answer: Callable[[pa.Table, Iterator[pa.Table]], Best], score_type: str, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: ``answer`` holds a group of queries against what ``prepare`` made of each block of candidates."""
    blocks = write_blocks(candidates, "vectors", CANDIDATE_BLOCK, prepare)

    def run(left: pa.Table, met: Iterator[pa.Table]) -> pa.Table:
        return answer(left, met).table()

    return ranked(answered(queries, blocks, run, f"query_id long, vec_id long, score {score_type}", QUERY_BLOCK), k)
