"""Operator 12, ranked lexical search: documents ranked for queries by a bit-sliced index of impacts.

*Index.* Each task cuts its documents into blocks of up to ``BLOCK`` rows or ``BLOCK_BYTES`` of text and writes, for each
term of a block, where it stands and how often, and for the block its documents and their lengths. Counts of documents,
of terms and of documents that hold a term are sums over these rows.

*Search.* A posting's impact is a whole number that needs no query, so a term of a block is a column of numbers: it is
kept as bitmaps, one for each bit (slice). A query's terms are added up slice by slice with bitwise sums and carries, in
pairs of terms until one number of slices is left; no document is looked at for itself. The best documents are found
from the most significant slice down: documents that have the bit go before those that have not, until ``k`` are left.
Queries are dealt into groups of about ``QUERIES``; a block meets each group once, and hands on ``k`` rows a query.

Defined results: a null or empty text, and one without a term, has no term and is in no count; a document row without
an id counts and stands last among equals, as null; repeated rows count each; rows of a query with one id are one query of
all their terms; a query without an id, or without a term that a document holds, has no result; equal scores go by
smaller doc_id; empty tables have an empty result; other columns are not read.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leksika.llm.common import Words, materialise, pieces, table

#: Rows and bytes of text of a block; queries of a group; bytes of slices that are added up at once.
BLOCK, BLOCK_BYTES, QUERIES, ADDED = 8192, 64 << 20, 512, 4 << 20
#: Results of a query.
TOP = 10

#: What separates terms, and the bytes of UTF-8 that are inside of one.
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TERM = np.array([chr(b).isalnum() or b >= 128 for b in range(256)])

INDEX = "block long, term string, n_docs long, n_terms long, docs binary, counts binary"
FOUND = "item_id long, doc_id long, score long"


def terms_of(text: Column) -> Column:
    """The terms of a text, A-Z lower-cased, with repeats."""
    return F.filter(F.split(F.translate(text, string.ascii_uppercase, string.ascii_lowercase), GAP), lambda t: t != "")


class Block:
    """Documents of a block as they come, each piece's distinct terms beside (term, document, count)."""

    def __init__(self) -> None:
        self.ids: list[int | None] = []
        self.lengths, self.terms, self.postings = [], [], []
        self.bytes = 0

    def add(self, part: pa.RecordBatch) -> None:
        words = Words(part.column("text"), lower=True, inside=TERM)
        n = part.num_rows
        lengths = words.ends - words.starts
        of = np.repeat(np.arange(n), lengths)
        pairs, counts = np.unique(words.codes * n + of, return_counts=True)
        self.terms.append(words.distinct)
        self.postings.append((pairs // n, pairs % n + len(self.ids), counts))
        self.lengths.append(lengths)
        self.ids += part.column("doc_id").to_pylist()
        self.bytes += part.column("text").nbytes

    def rows(self, number: int) -> pa.RecordBatch:
        """One row of the block (its term is null: ids, which are known, lengths) and one for each term."""
        known = np.array([i is not None for i in self.ids])
        ids = np.array([i or 0 for i in self.ids], np.int64)
        order = np.lexsort((ids, ~known))  # places in the block go by id, so that ties do
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        lengths = np.concatenate(self.lengths).astype(np.int64)[order]
        coded = pa.chunked_array(self.terms, pa.large_binary()).combine_chunks().dictionary_encode()
        codes, of = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.cumsum([0, *(len(t) for t in self.terms)])
        term = np.concatenate([codes[c + start] for (c, _, _), start in zip(self.postings, of[:-1], strict=True)])
        doc = place[np.concatenate([d for _, d, _ in self.postings])]
        count = np.concatenate([c for _, _, c in self.postings])
        by = np.lexsort((doc, term))
        ends = np.searchsorted(term[by], np.arange(len(coded.dictionary) + 1))
        sizes = np.diff(ends)
        cut = lambda values, width: pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer((ends * width).astype(np.int32)), pa.py_buffer(values)])
        head = [[number], [None], [int((lengths > 0).sum())], [int(lengths.sum())], [ids[order].tobytes() + np.packbits(known[order]).tobytes()], [lengths.tobytes()]]
        names = ["block", "term", "n_docs", "n_terms", "docs", "counts"]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        first = pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(head, kinds, strict=True)], names)
        terms = coded.dictionary.cast(pa.large_string()).cast(pa.string())
        rest = [pa.array(np.full(len(sizes), number)), terms, pa.array(sizes), pa.array(np.zeros(len(sizes), np.int64)), cut(doc[by].astype(np.uint16), 2), cut(count[by].astype(np.uint32), 4)]
        return pa.concat_batches([first, pa.RecordBatch.from_arrays(rest, names)])


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    number, block = TaskContext.get().partitionId() << 32, Block()
    for part in pieces(batches):
        while part.num_rows:
            room = BLOCK - len(block.ids)
            block.add(part.slice(0, room))
            part = part.slice(room)
            if len(block.ids) == BLOCK or block.bytes >= BLOCK_BYTES:
                yield block.rows(number)
                number, block = number + 1, Block()
    if block.ids:
        yield block.rows(number)


def index(docs: DataFrame) -> DataFrame:
    """The postings of all terms of ``docs`` (doc_id, text), block by block, written to the shared folder."""
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return materialise(picked.mapInArrow(blocks, INDEX), "postings")


def sliced(places: np.ndarray, values: np.ndarray, bits: int, words: int) -> np.ndarray:
    """(bits, words): a bitmap of 64 documents a word for each bit of the values."""
    out = np.zeros((bits, words * 64), np.uint8)
    out[:, places] = (values >> np.arange(bits)[:, None]) & 1
    return np.packbits(out, axis=1, bitorder="little").view(np.uint64)


def added(slices: np.ndarray) -> np.ndarray:
    """(bits, queries, words) sums of (bits, queries, terms, words): pairs of terms are added bit by bit with a carry."""
    while slices.shape[2] > 1:
        if slices.shape[2] % 2:
            slices = np.concatenate((slices, np.zeros_like(slices[:, :, :1])), axis=2)
        half = slices.shape[2] // 2
        x, y = slices[:, :, :half], slices[:, :, half:]
        out = np.empty((len(slices) + 1, *x.shape[1:]), np.uint64)
        carry, both = np.zeros(x.shape[1:], np.uint64), np.empty(x.shape[1:], np.uint64)
        for j in range(len(slices)):
            np.bitwise_and(x[j], y[j], out=both)
            one = x[j] ^ y[j]
            np.bitwise_xor(one, carry, out=out[j])
            one &= carry
            np.bitwise_or(both, one, out=carry)
        out[-1] = carry
        slices = out
    return slices[:, :, 0]


def highest(slices: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest numbers above 0 of (bits, words), ties to lower places; all, if fewer."""
    even, sure = np.bitwise_or.reduce(slices, axis=0), np.zeros_like(slices[0])
    if int(np.bitwise_count(even).sum()) > k:
        for bits in slices[::-1]:
            with_bit = even & bits
            best = sure | with_bit
            n = int(np.bitwise_count(best).sum())
            if n > k:
                even = with_bit
            else:
                sure, even = best, even & ~bits
                if n == k:
                    break
    at = lambda bitmap: np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))
    chosen = at(sure)
    return np.sort(np.append(chosen, at(even)[: k - len(chosen)]))


def searcher(n_docs: int, n_terms: int, k: int):
    """The best ``k`` documents of a block for each query of a group."""

    def search(rows: pa.Table) -> pa.Table:
        is_head = pc.is_null(rows.column("term"))
        head, rows = rows.filter(is_head).to_pylist()[0], rows.filter(pc.invert(is_head)).combine_chunks()
        lengths = np.frombuffer(head["counts"], np.int64)
        size = len(lengths)
        ids, known = np.frombuffer(head["docs"], np.int64, size), np.unpackbits(np.frombuffer(head["docs"], np.uint8, offset=8 * size))[:size].astype(bool)
        damped = 8 * (10 + (90 * lengths * n_docs) // max(1, n_terms))
        words = -(-size // 64)
        impacts = []
        for docs, counts, weight in zip(rows.column("docs").to_pylist(), rows.column("counts").to_pylist(), rows.column("weight").to_pylist(), strict=True):
            places, tf = np.frombuffer(docs, np.uint16).astype(np.int64), np.frombuffer(counts, np.uint32).astype(np.int64)
            impacts.append((places, weight * ((1_000_000_000 * tf) // (1000 * tf + damped[places]))))
        bits = max((int(v.max()).bit_length() for _, v in impacts), default=0)
        wanted: dict[int, list[int]] = {}
        for number, items in enumerate(rows.column("items").to_pylist()):
            for item in items:
                wanted.setdefault(item, []).append(number)
        out: list[tuple[int, int | None, int]] = []
        if not bits:
            wanted = {}
        # Queries of about as many terms are added up together, as many as fit into ADDED bytes.
        queue = sorted(wanted, key=lambda i: (len(wanted[i]), i))
        while queue:
            terms = len(wanted[queue[-1]])
            now, queue = queue[-max(1, ADDED // (bits * terms * words * 8)) :], queue[: -max(1, ADDED // (bits * terms * words * 8))]
            mine = sorted({t for i in now for t in wanted[i]})
            at = {t: x for x, t in enumerate(mine)}
            maps = np.zeros((bits, len(mine) + 1, words), np.uint64)  # the last is empty
            for t, x in at.items():
                maps[:, x] = sliced(*impacts[t], bits, words)
            numbers = np.array([[at[t] for t in wanted[i]] + [len(mine)] * (terms - len(wanted[i])) for i in now])
            sums = added(maps[:, numbers])
            for q, item in enumerate(now):
                own = np.ascontiguousarray(sums[:, q])
                places = highest(own, k)
                values = ((own[:, places >> 6] >> (places & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64)
                scores = (values << np.arange(len(own))[:, None]).sum(axis=0)
                out += [(item, int(ids[p]) if known[p] else None, int(s)) for p, s in zip(places, scores, strict=True)]
        columns = list(zip(*out, strict=True)) or [[], [], []]
        return pa.table([pa.array(c, pa.int64()) for c in columns], ["item_id", "doc_id", "score"])

    return search


def search(postings: DataFrame, queries: DataFrame, k: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of an ``index`` for each of ``queries`` (item_id, text)."""
    heads, terms = postings.where("term is null"), postings.where("term is not null")
    n_docs, n_terms = heads.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    asked = queries.select(F.col("item_id").cast("long").alias("item_id"), F.explode(terms_of(F.col("text").cast("string"))).alias("term")).where("item_id is not null").distinct()
    groups = max(1, -(-queries.select("item_id").distinct().count() // QUERIES))
    held = terms.join(asked.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("n_docs").alias("df"))
    weight = F.floor(1000 * F.log((2 * F.lit(n_docs) + 2) / (2 * F.col("df") + 1))).cast("long")
    wanted = asked.withColumn("group", F.pmod(F.xxhash64("item_id"), F.lit(groups)).cast("int")).groupBy("term", "group").agg(F.collect_set("item_id").alias("items"))
    wanted = wanted.join(held, "term").select("term", "group", "items", weight.alias("weight"))
    found = terms.join(wanted, "term").select("block", "group", "term", "docs", "counts", "weight", "items")
    every = heads.select("block", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), "term", "docs", "counts", F.lit(0).cast("long").alias("weight"), F.array().cast("array<long>").alias("items"))
    best = found.unionByName(every).groupBy("block", "group").applyInArrow(searcher(n_docs, n_terms, k), FOUND)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def rank_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark WHERE item_id IS NOT NULL
), s AS (SELECT count(*)::bigint AS n_docs, sum(len(terms))::bigint AS n_terms FROM d WHERE len(terms) > 0
), p AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL
), f AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)))::bigint AS w FROM p, s GROUP BY term, n_docs
), scored AS (
  SELECT q.item_id, p.r, p.doc_id, sum(f.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * (10 + (90 * p.n * s.n_docs) // s.n_terms))))::bigint AS score
  FROM q JOIN p USING (term) JOIN f USING (term), s GROUP BY q.item_id, p.r, p.doc_id
)
SELECT item_id, rank::int AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank FROM scored WHERE score > 0
) WHERE rank <= 10
"""
