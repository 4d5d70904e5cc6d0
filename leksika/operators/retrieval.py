"""Lookups: exact, nonstandard, prefix, nearest, cascade, citations."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from leksika.functions.text import lookup_key, strip_space
from leksika.functions.vectors import DISTANCES
from leksika.session import written
from leksika.sources.blocks import answered, first_places, write_blocks

OFFICIAL = ("official-live", "official-snapshot")
MOST = 50


def cap(limit: int) -> int:
    """1 to 50."""
    return min(max(1, int(limit)), MOST)


def active_official(source_kind: str = "source_kind", status: str = "status") -> Column:
    """What the public may read."""
    return (F.col(status) == "active") & F.col(source_kind).isin(*OFFICIAL)


def latest(entries: DataFrame, key: str = "lema_lc", order: str = "doc_id") -> DataFrame:
    """The last entry written for each key. Only keys and order are aggregated; the rows are fetched by them."""
    return fetched(entries, entries.groupBy(key).agg(F.max(order).alias(order)), key, order)


def fetched(entries: DataFrame, places: DataFrame, key: str, order: str) -> DataFrame:
    """One entry for each key and place of ``places``."""
    return entries.join(places, [key, order] if key in entries.columns else order).dropDuplicates([key])


def exact(queries: DataFrame, entries: DataFrame) -> DataFrame:
    """Query -> the active official entry of that word; an equi-join on the stored key. Entries that nobody asks for are dropped before the last of each key is sought."""
    asked = queries.select("query", lookup_key(F.col("query")).alias("lema_lc")).distinct()
    return asked.join(latest(entries.join(asked.select("lema_lc").distinct(), "lema_lc", "left_semi")), "lema_lc").where(active_official())


def nonstandard(queries: DataFrame, entries: DataFrame, order: str = "doc_id") -> DataFrame:
    """Query -> the first active official entry that lists the word as a variant."""
    asked = queries.select("query", lookup_key(F.col("query")).alias("variant")).distinct()
    official = entries.where(active_official())
    listed = official.select(order, F.explode(F.array_distinct(F.transform("variants", F.lower))).alias("variant")).join(asked.select("variant").distinct(), "variant", "left_semi")
    return asked.join(fetched(official, listed.groupBy("variant").agg(F.min(order).alias(order)), "variant", order), "variant").select("query", *entries.columns)


def relation(queries: DataFrame, entries: DataFrame) -> DataFrame:
    """A direct entry, else the entry that lists the word; ``via`` tells which."""
    direct = exact(queries, entries).select("query", "id", "lema", F.lit(0).alias("rank"), F.lit("lema").alias("via"))
    listed = nonstandard(queries, entries).select("query", "id", "lema", F.lit(1).alias("rank"), F.lit("variant").alias("via"))
    return direct.unionAll(listed).groupBy("query").agg(F.min_by(F.struct("id", "lema", "via"), "rank").alias("r")).select("query", "r.*")


def prefix(entries: DataFrame, word: str, limit: int = 20) -> DataFrame:
    """Entries whose key begins with ``word``; the prefix is pushed to the scan."""
    return entries.where(F.col("lema_lc").startswith(word.strip().lower()) & active_official()).orderBy("lema_lc", "id").limit(cap(limit))


def prefix_join(queries: DataFrame, entries: DataFrame, limit: int = 20, shortest: int = 3) -> DataFrame:
    """J05 for many words: an equi-join on a whole prefix of each length asked for, so a common beginning meets only those who ask for it; id and order alone are ranked, and the rows of the winners fetched.

    A prefix that is asked for collects at most ``limit`` entries of each task before they are ranked.
    """
    asked = queries.select("query", lookup_key(F.col("query")).alias("key")).where(F.length("key") >= shortest).distinct()
    lengths = [r[0] for r in asked.select(F.length("key")).distinct().orderBy(F.length("key")).collect()]  # word lengths: few, whatever the number of queries
    if not lengths:
        return entries.where("false").select(F.lit("").alias("query"), "*", F.lit(0).alias("rank"))
    official = entries.where(active_official()).select("lema_lc", "id")
    heads = F.array_distinct(F.filter(F.array(*[F.when(F.length("lema_lc") >= n, F.substring("lema_lc", 1, n)) for n in lengths]), lambda x: x.isNotNull()))
    # A key's row in each of 64 parts keeps its first few, so a beginning that a third of all entries have is ranked in parts.
    met = official.withColumn("key", F.explode(heads)).join(asked.select("key").distinct(), "key", "left_semi").withColumn("part", F.pmod(F.xxhash64("id"), F.lit(64)))
    few = met.withColumn("rank", F.row_number().over(Window.partitionBy("key", "part").orderBy("lema_lc", "id"))).where(F.col("rank") <= cap(limit))
    first = few.withColumn("rank", F.row_number().over(Window.partitionBy("key").orderBy("lema_lc", "id"))).where(F.col("rank") <= cap(limit)).select("key", "id", "rank")
    won = asked.join(first, "key").select("query", "id", "rank")
    return won.join(entries, "id").where(active_official()).select("query", *entries.columns, "rank")


def nearest(vectors: DataFrame, query: Column, k: int = 10, measure: str = "DOT_PRODUCT", keep: Column | None = None, max_distance: float | None = None) -> DataFrame:
    """The ``k`` nearest of one query vector; a filter before, a threshold, then top-k."""
    rows = vectors if keep is None else vectors.where(keep)
    scored = rows.withColumn("distance", DISTANCES[measure](F.col("embedding"), query))
    if max_distance is not None:
        scored = scored.where(F.col("distance") <= max_distance)
    return scored.orderBy("distance", "vec_id").limit(cap(k))


#: Queries of a task at most, vectors of a block, and queries that are held against a block at once.
QUERY_BLOCK, VECTOR_BLOCK, STEP = 4096, 16384, 256


def distances(q: np.ndarray, x: np.ndarray, measure: str) -> np.ndarray:
    """F32 for all pairs of rows."""
    products = q @ x.T
    if measure == "DOT_PRODUCT":
        return 1.0 - products
    if measure == "COSINE":
        norms = np.sqrt((q * q).sum(axis=1))[:, None] * np.sqrt((x * x).sum(axis=1))[None, :]
        return np.where(norms == 0, 1.0, 1.0 - products / np.where(norms == 0, 1.0, norms))
    return np.sqrt(np.maximum((q * q).sum(axis=1)[:, None] + (x * x).sum(axis=1)[None, :] - 2 * products, 0.0))


def padded(vectors: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors as rows of one width, zeros added, and their lengths."""
    array = vectors.combine_chunks()
    lengths = np.diff(np.array(array.offsets)).astype(np.int64)
    out = np.zeros((len(lengths), max(1, lengths.max(initial=0))))
    out[np.arange(out.shape[1]) < lengths[:, None]] = np.array(array.flatten())
    return out, lengths


def paired(q: np.ndarray, long_q: np.ndarray, x: np.ndarray, long_x: np.ndarray, measure: str) -> np.ndarray:
    """``distances`` of padded vectors, of whose components those are paired that both have."""
    width = max(q.shape[1], x.shape[1])
    q, x = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (q, x))
    if measure != "EUCLIDEAN" or len(lengths := np.union1d(long_q, long_x)) == 1:
        return distances(q, x, measure)  # added zeros are in no product and no norm
    out = np.empty((len(q), len(x)))
    for a in np.unique(long_q):
        for b in np.intersect1d(lengths, long_x):
            rows, columns, both = np.flatnonzero(long_q == a), np.flatnonzero(long_x == b), min(a, b)
            out[np.ix_(rows, columns)] = distances(q[rows, :both], x[columns, :both], measure)
    return out


def nearest_batch(queries: DataFrame, vectors: DataFrame, k: int = 3, measure: str = "DOT_PRODUCT", max_distance: float | None = None, others: bool = True) -> DataFrame:
    """J06 for any number of queries (query_id, query): each query's ``k`` nearest vectors (vec_id, embedding), its own id left out if ``others``.

    Vectors are written once, in blocks of bounded size; queries are dealt to tasks, which go through the blocks and hold
    the ``k`` of each query so far. Of two lengths the shorter counts, as far as components are paired; norms are of whole
    vectors. Ties go by smaller vec_id, in a block as in the end, so a vector with many copies is ``k`` rows of a block.
    Rows without an id or a vector take no part.
    """
    asked = queries.where("query_id is not null and query is not null").select("query_id", F.col("query").cast("array<double>").alias("v"))
    rows = vectors.where("vec_id is not null and embedding is not null").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    out = T.StructType([T.StructField("query_id", asked.schema["query_id"].dataType), T.StructField("vec_id", rows.schema["vec_id"].dataType), T.StructField("distance", T.DoubleType())])

    def prepare(table: pa.Table) -> pa.Table:
        return table.sort_by("vec_id")

    def near(left: pa.Table, right: pa.Table) -> pa.Table:
        """The first ``k`` of a block for each query."""
        ids, vec_ids = (t.column(c).combine_chunks() for t, c in ((left, "query_id"), (right, "vec_id")))
        (q, long_q), (x, long_x) = padded(left.column("v")), padded(right.column("v"))
        d = paired(q, long_q, x, long_x, measure)
        if others:
            d[np.array(ids)[:, None] == np.array(vec_ids)[None, :]] = np.inf
        first = d < np.inf if max_distance is None else d <= max_distance
        if len(vec_ids) > k:
            last = np.partition(d, k - 1, axis=1)[:, k - 1 : k]
            nearer, tied = d < last, d == last
            first &= nearer | (tied & (np.cumsum(tied, axis=1, dtype=np.int32) <= k - nearer.sum(axis=1, keepdims=True)))
        i, j = np.nonzero(first)
        return pa.table({"query_id": ids.take(pa.array(i)), "vec_id": vec_ids.take(pa.array(j)), "distance": pa.array(d[i, j])})

    def answer(left: pa.Table, blocks: Iterator[pa.Table]) -> pa.Table:
        held = None
        for block in blocks:
            for at in range(0, left.num_rows, STEP):
                found = near(left.slice(at, STEP), block)
                held = found if held is None else pa.concat_tables([held, found])
            held = held.sort_by([("query_id", "ascending"), ("distance", "ascending"), ("vec_id", "ascending")]).combine_chunks()
            of = held.column("query_id").combine_chunks().dictionary_encode().indices.to_numpy()
            held = held.filter(pa.array(first_places(of) < k))
        return held if held is not None else nothing

    nothing = to_arrow_schema(out).empty_table()
    blocks = write_blocks(rows, "vectors", VECTOR_BLOCK, prepare)
    met = answered(asked, blocks, answer, out, QUERY_BLOCK)
    order = Window.partitionBy("query_id").orderBy("distance", "vec_id")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "distance")


def adapted(hits: DataFrame, threshold: float) -> DataFrame:
    """Hits within a distance whose similarity reaches the same number, most similar first."""
    return hits.withColumn("similarity", 1 - F.col("distance")).where((F.col("distance") <= threshold) & (F.col("similarity") >= threshold)).orderBy(F.desc("similarity"), "vec_id")


def hydrate(hits: DataFrame, entries: DataFrame, min_similarity: float = 0.7) -> DataFrame:
    """Hits with their entries; filters come after the top-k, so there may be fewer than k."""
    scored = hits.withColumn("similarity", 1 - F.col("distance")).where(F.col("similarity") >= min_similarity)
    return scored.join(entries, scored.vec_id == entries.doc_id).where(active_official())


def hydrated(hits: DataFrame, entries: DataFrame) -> DataFrame:
    """Hits (doc_id, lema) with their entry: by word, else by what stands before the first ``_`` of the id, else by the whole id; hits without one are left out.

    The ways of all hits meet keys and ids of entries in one join; the last entry of a key is its place, and the
    rows of the places are fetched at the end.
    """
    numbered = hits.withColumnsRenamed({"doc_id": "hit_id", "lema": "hit_lema"})
    way = lambda rank, kind, key: F.struct(F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), key.alias("key"))
    ways = F.array(way(0, "lema", lookup_key(F.col("hit_lema"))), way(1, "id", F.substring_index("hit_id", "_", 1)), way(2, "id", F.col("hit_id")))
    asked = numbered.withColumn("__way", F.explode(ways)).where("__way.key <> ''").select(*numbered.columns, "__way.rank", "__way.kind", "__way.key")
    named = lambda kind, key: F.struct(F.lit(kind).alias("kind"), F.col(key).alias("key"))
    keys = entries.select("doc_id", F.explode(F.array(named("lema", "lema_lc"), named("id", "id"))).alias("of")).select("doc_id", "of.kind", "of.key")
    places = keys.join(asked.select("kind", "key").distinct(), ["kind", "key"], "left_semi").groupBy("kind", "key").agg(F.max("doc_id").alias("doc_id"))
    order = Window.partitionBy(*numbered.columns).orderBy("rank")
    first = asked.join(places, ["kind", "key"]).withColumn("__n", F.row_number().over(order)).where("__n = 1").select(*numbered.columns, "doc_id")
    return first.join(entries, "doc_id")


def semantic(queries: DataFrame, entries: DataFrame, vectors: DataFrame, embed: Callable[[Column], Column], limit: int = 10, threshold: float = 0.7) -> DataFrame:
    """The third tier: each query is embedded, its nearest vectors (vec_id, doc_id, lema, embedding) are fetched, hydrated, and what may be read is kept, most similar first.

    The top ``limit`` comes before the filters, so there may be fewer. Blank queries, and an embedding that is null, find nothing.
    """
    asked = queries.select("query").where(strip_space(F.col("query")) != "").distinct().withColumn("vector", embed(strip_space(F.col("query"))))
    near = nearest_batch(asked.select(F.col("query").alias("query_id"), F.col("vector").alias("query")), vectors, cap(limit), max_distance=1 - threshold, others=False)
    near = near.withColumn("similarity", 1 - F.col("distance")).where(F.col("similarity") >= threshold)
    named = near.join(vectors.select("vec_id", "doc_id", "lema"), "vec_id").select(F.col("query_id").alias("query"), "similarity", "vec_id", "doc_id", "lema")
    kept = hydrated(written(named, "hits"), entries).where(active_official())
    order = Window.partitionBy("query").orderBy(F.desc("similarity"), "vec_id")
    return kept.withColumn("rank", F.row_number().over(order))


def cascade(queries: DataFrame, entries: DataFrame, limit: int = 20, vectors: DataFrame | None = None, embed: Callable[[Column], Column] | None = None, threshold: float = 0.7, semantic_limit: int = 10) -> DataFrame:
    """Exact, else prefix (three letters or more), else, with ``vectors`` and ``embed``, semantic; the first tier that answers a query wins. Queries go on only while none has."""
    queries = written(queries.select("query").distinct(), "queries")
    first = written(exact(queries, entries).select("query", "id", "lema", F.lit("exact").alias("tier")), "exact")
    left = queries.join(first.select("query"), "query", "left_anti")
    second = written(prefix_join(left, entries, limit).select("query", "id", "lema", F.lit("prefix").alias("tier")), "prefix")
    if vectors is None or embed is None:
        return first.unionAll(second)
    left = left.join(second.select("query"), "query", "left_anti")
    third = semantic(left, entries, vectors, embed, semantic_limit, threshold).select("query", "id", "lema", F.lit("semantic").alias("tier"))
    return first.unionAll(second).unionAll(third)


def citation(release: str | None = None, generation: str | None = None) -> Column:
    """Provenance of a row, without clocks."""
    return F.struct(
        F.col("id").alias("entryId"), F.col("source_kind").alias("sourceKind"), F.col("edition").alias("edition"),
        F.sha2("definisi", 256).alias("contentHash"), F.lit(release).alias("releaseVersion"), F.lit(generation).alias("generation"),
    )
