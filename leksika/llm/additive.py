"""Approximate nearest neighbours by additive quantisation.

A vector is coded as a scale times the sum of one full-dimensional codeword from each of several
codebooks. Codebooks start as k-means of residuals over a bounded sample of distinct vectors and are
then refitted together by least squares on beam-searched codes. Every row is encoded by beam search; its
code and scale, the stored norm, are its index entry. A query's inner products with all codewords make
a lookup table; the table scores every indexed row, and the best of each block are reranked exactly.

Defined results: vectors that are null, zero or hold a null or non-finite component take no part, nor
do rows with a null id; the shorter of two vectors ends in zeros, and codebooks are as wide as the widest
vector of the sample, so components beyond that count in the reranking alone; ties go to the smaller id; rows that
repeat an id count as one candidate and one query, with the best score; an empty table gives an empty
result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leksika.llm.common import among_least, discard, materialise
from leksika.llm.vectors import Best, Distinct, against_all, matrix, usable, widen

#: Distinct vectors that codebooks are fitted on at most: those with the smallest hashes.
SAMPLE = 8192
BOOKS, WORDS, BEAM, ROUNDS = 16, 256, 4, 6
#: Entries of a block of 16,384 that are reranked for each query.
QUERIES_AT, K, RERANK = 20, 20, 256
#: Queries that are scored against a block at once.
STEP = 64


def k_means(x: np.ndarray, words: int, rng: np.random.Generator) -> np.ndarray:
    centres = x[rng.choice(len(x), words, replace=False)].copy()
    for _ in range(ROUNDS):
        near = ((centres * centres).sum(axis=1)[None, :] - 2 * (x @ centres.T)).argmin(axis=1)
        sums = np.stack([np.bincount(near, x[:, d], words) for d in range(x.shape[1])], axis=1)
        sizes = np.bincount(near, minlength=words)
        centres = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centres).astype(np.float32)
    return centres


def encode(x: np.ndarray, books: np.ndarray, beam: int = BEAM) -> np.ndarray:
    """The code of each row of ``x``: for each codebook the number of its codeword, by beam search over residuals."""
    n, (m, words, _) = len(x), books.shape
    left = x[:, None, :].astype(np.float32)  # residuals of the beam
    cost = np.einsum("nbd,nbd->nb", left, left)
    codes = np.zeros((n, 1, m), np.uint8)
    for book in range(m):
        c = books[book]
        reached = cost[:, :, None] + (c * c).sum(axis=1) - 2 * (left @ c.T)
        flat = reached.reshape(n, -1)
        width = min(beam, flat.shape[1])
        top = np.argpartition(flat, width - 1, axis=1)[:, :width]
        source, word = top // words, top % words
        rows = np.arange(n)[:, None]
        left, cost = left[rows, source] - c[word], flat[rows, top]
        codes = codes[rows, source]
        codes[:, :, book] = word
    return codes[np.arange(n), cost.argmin(axis=1)]


def decode(codes: np.ndarray, books: np.ndarray) -> np.ndarray:
    return sum(books[m][codes[:, m]] for m in range(len(books)))


def refit(x: np.ndarray, codes: np.ndarray, books: np.ndarray) -> np.ndarray:
    """Least squares for all codewords at once, with the codes as they are."""
    m, words, dim = books.shape
    column = codes.astype(np.int64) + np.arange(m) * words
    gram = np.zeros((m * words, m * words), np.float32)
    for a in range(m):
        for b in range(m):
            both = np.bincount(codes[:, a].astype(np.int64) * words + codes[:, b], minlength=words * words)
            gram[a * words : (a + 1) * words, b * words : (b + 1) * words] = both.reshape(words, words)
    target = np.zeros((m * words, dim), np.float32)
    for a in range(m):
        np.add.at(target, column[:, a], x)
    ridge = np.float32(0.5)
    gram[np.diag_indices_from(gram)] += ridge
    return np.linalg.solve(gram, target + ridge * books.reshape(-1, dim)).astype(np.float32).reshape(m, words, dim)


def directions(x: np.ndarray) -> np.ndarray:
    largest = np.abs(x).max(axis=1, keepdims=True)
    x = x / largest
    return (x / np.sqrt((x * x).sum(axis=1, keepdims=True))).astype(np.float32)


def fit_books(sample: np.ndarray, books: int = BOOKS, words: int = WORDS, seed: int = 11) -> np.ndarray:
    x = directions(np.unique(sample, axis=0))
    rng, words = np.random.default_rng(seed), min(words, len(x))
    found, left = [], x.copy()
    for _ in range(books):
        centres = k_means(left, words, rng)
        near = ((centres * centres).sum(axis=1)[None, :] - 2 * (left @ centres.T)).argmin(axis=1)
        left = left - centres[near]
        found.append(centres)
    fitted = np.stack(found)
    return refit(x, encode(x, fitted), fitted)


def train(vectors: DataFrame, sample: int = SAMPLE) -> np.ndarray | None:
    """Codebooks (books, words, dimensions) from a bounded sample of distinct vectors, copies counted once; None without vectors."""
    hashed = vectors.select("vec", F.xxhash64("vec").alias("h"))
    total = hashed.agg(F.approx_count_distinct("h", 0.02)).first()[0]

    def least(some: DataFrame) -> pa.Table:
        return some.distinct().orderBy(F.shiftrightunsigned("h", 1), "h").limit(sample).toArrow()

    rows = least(hashed.where(among_least(F.col("h"), sample, total)))
    if rows.num_rows < sample < total:
        rows = least(hashed)
    return fit_books(matrix(rows.column("vec"))) if rows.num_rows else None


def index(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """id, vec (packed), code, scale of every row of ``vectors`` (id, vec)."""
    shared = vectors.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                x = matrix(part.column("vec"))
                norms = np.sqrt((x * x).sum(axis=1))
                d = directions(x)
                d = widen(d, c.shape[2]) if d.shape[1] <= c.shape[2] else d[:, : c.shape[2]]
                codes = encode(d, c)
                y = decode(codes, c)
                scale = norms * (d * y).sum(axis=1) / np.maximum((y * y).sum(axis=1), 1e-12)
                yield pa.RecordBatch.from_arrays([part.column("id"), packed(x), pa.array([x.tobytes() for x in codes], pa.binary()), pa.array(scale.astype(np.float64))], ["id", "vec", "code", "scale"])

    return vectors.mapInArrow(run, "id long, vec binary, code binary, scale double")


def packed(x: np.ndarray) -> pa.Array:
    """Rows of doubles as bytes, without the zeros they end in: in 32 bits a component where that is exact, told by the first byte."""
    with np.errstate(over="ignore"):
        short = x.astype(np.float32)
    exact = (short == x).all(axis=1)
    return pa.array([b"4" + np.trim_zeros(s, "b").tobytes() if e else b"8" + np.trim_zeros(v, "b").tobytes() for s, v, e in zip(short, x, exact, strict=True)], pa.binary())


def unpacked(column: pa.ChunkedArray) -> np.ndarray:
    """Rows of doubles as wide as the widest."""
    rows = [np.frombuffer(r, "<f4" if r[:1] == b"4" else "<f8", offset=1) for r in column.to_pylist()]
    out = np.zeros((len(rows), max(map(len, rows), default=0)))
    for row, values in zip(out, rows, strict=True):
        row[: len(values)] = values
    return out


def search(queries: DataFrame, indexed: DataFrame, books: np.ndarray, k: int = K, rerank: int = RERANK) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` largest inner products found for each query (id, vec)."""
    shared = queries.sparkSession.sparkContext.broadcast(books)

    def prepare(table: pa.Table) -> pa.Table:
        have, taken = Distinct.of(table.column("id").to_numpy(), unpacked(table.column("vec")), k + 1)
        entries = table.select(["code", "scale"]).take(pa.array(taken)).combine_chunks()
        made = have.table(np.float32)
        return made.append_column("code", entries.column("code")).append_column("scale", entries.column("scale"))

    def answer(left: pa.Table, blocks: Iterator[pa.Table]) -> Best:
        c, held = shared.value, Best(k, np.float64)
        m, _, dim = c.shape
        asked, ids = matrix(left.column("vec")), left.column("id").to_numpy()
        for block in blocks:
            have = Distinct.read(block)
            width = max(asked.shape[1], have.rows.shape[1], dim)
            q, have.rows = widen(asked, width), widen(have.rows, width)
            codes = np.frombuffer(b"".join(block.column("code").to_pylist()), np.uint8).reshape(-1, m).astype(np.int64)
            scale = block.column("scale").to_numpy().astype(np.float32)
            most = min(len(scale), max(rerank, k + 1))
            for at in range(0, len(q), STEP):
                mine = q[at : at + STEP]
                tables = np.einsum("qd,mwd->mqw", mine[:, :dim].astype(np.float32), c, optimize=True)
                scores = np.zeros((len(mine), len(scale)), np.float32)
                for book in range(m):
                    scores += np.take(tables[book], codes[:, book], axis=1)
                scores *= scale
                near = np.argpartition(scores, len(scale) - most, axis=1)[:, len(scale) - most :]
                exact = (mine[:, None, :] * have.rows[near]).sum(axis=2)
                held.add(ids[at : at + STEP], np.repeat(np.arange(len(mine)), most), near.ravel(), exact.ravel(), have)
        return held

    return against_all(queries, indexed, prepare, answer, "double", k)


def nearest(vectors: DataFrame, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding", every: int = QUERIES_AT) -> DataFrame:
    """Train, index every row and answer the rows whose id is divisible by ``every``."""
    rows = usable(vectors, id_col, vec_col, zero=False)
    books = train(rows)
    if books is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    indexed = materialise(index(rows, books), "index")
    found = search(rows.where(F.col("id") % every == 0), indexed, books, k)
    discard(indexed)
    return found
