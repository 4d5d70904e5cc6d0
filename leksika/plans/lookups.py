"""Queries that look words and vectors up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leksika.functions.hashing import pseudo_vector
from leksika.operators import retrieval as R
from leksika.plans.registry import Registry
from leksika.session import written
from leksika.sources import tables as T

query = Registry()
OFFICIAL = "status = 'active' AND source_kind IN ('official-live', 'official-snapshot')"
ASKED = r"asked AS (SELECT DISTINCT lower(regexp_extract(text, '^(\S+)', 1)) AS query FROM benchmark)"
LATEST = "latest AS (SELECT * FROM entries QUALIFY row_number() OVER (PARTITION BY lema_lc ORDER BY doc_id DESC) = 1)"


def asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first word of each text of ``benchmark``."""
    return T.read(spark, sf_dir, "benchmark").select(F.lower(F.regexp_extract("text", T.FIRST_WORD, 1)).alias("query")).distinct()


def narrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What lookups read of the entries, derived from the whole texts once for all tiers and read back by column."""
    return written(T.entries(spark, sf_dir).select("doc_id", "id", "lema", "lema_lc", "source_kind", "status"), "entries")


@query(f"""WITH {T.ENTRIES_SQL}
SELECT id, lema, source_kind AS kind, edition, sha256(definisi) AS content_hash FROM entries
WHERE starts_with(lema_lc, 'th') AND {OFFICIAL} ORDER BY lema_lc, id LIMIT 20""")
def q_prefix_lookup(spark, sf_dir):
    """J05, T03, P01, P05."""
    found = R.prefix(T.entries(spark, sf_dir), "th").withColumn("citation", R.citation())
    return found.select("id", "lema", F.col("citation.sourceKind").alias("kind"), F.col("citation.edition").alias("edition"), F.col("citation.contentHash").alias("content_hash"))


@query(f"""WITH {T.ENTRIES_SQL}, {ASKED}, {LATEST}
SELECT query, id, lema FROM asked JOIN latest ON query = lema_lc WHERE {OFFICIAL}""")
def q_exact_lookup(spark, sf_dir):
    """J01, W09."""
    return R.exact(asked(spark, sf_dir), T.entries(spark, sf_dir)).select("query", "id", "lema")


LISTED = f"""listed AS (
  SELECT e.*, lower(v) AS variant FROM entries e, unnest(variants) AS u(v) WHERE {OFFICIAL}
), first_listed AS (SELECT variant, min(doc_id) AS doc_id FROM listed GROUP BY variant)"""


@query(f"""WITH {T.ENTRIES_SQL}, {ASKED}, {LISTED}
SELECT query, e.id AS id, e.lema AS lema FROM asked JOIN first_listed f ON query = f.variant JOIN entries e USING (doc_id)""")
def q_nonstandard_lookup(spark, sf_dir):
    """J02."""
    return R.nonstandard(asked(spark, sf_dir), T.entries(spark, sf_dir)).select("query", "id", "lema")


@query(f"""WITH {T.ENTRIES_SQL}, {ASKED}, {LATEST}, {LISTED}, both_ways AS (
  SELECT query, id, lema, 0 AS rank, 'lema' AS via FROM asked JOIN latest ON query = lema_lc WHERE {OFFICIAL}
  UNION ALL SELECT query, e.id, e.lema, 1, 'variant' FROM asked JOIN first_listed f ON query = f.variant JOIN entries e USING (doc_id))
SELECT query, id, lema, via FROM both_ways QUALIFY row_number() OVER (PARTITION BY query ORDER BY rank) = 1""")
def q_relation(spark, sf_dir):
    """J03, J04."""
    return R.relation(asked(spark, sf_dir), T.entries(spark, sf_dir))


PREFIXED = f"""met AS (
  SELECT query, id, lema, row_number() OVER (PARTITION BY query ORDER BY lema_lc, id) AS rank
  FROM asked JOIN entries ON starts_with(lema_lc, query) WHERE length(query) >= 3 AND {OFFICIAL})"""


@query(f"""WITH {T.ENTRIES_SQL}, {ASKED}, {PREFIXED} SELECT query, id, lema, CAST(rank AS INTEGER) AS rank FROM met WHERE rank <= 20""")
def q_prefix_join(spark, sf_dir):
    """J05 for many words."""
    return R.prefix_join(asked(spark, sf_dir), T.entries(spark, sf_dir)).select("query", "id", "lema", "rank")


UNIT = """list_transform(range(64), lambda i: (CAST('0x' || substr(d, CAST(i % 32 * 2 + 1 AS INTEGER), 2) AS INTEGER) / 127.5 - 1.0) * 0.1 + (i % 7) * 0.001)"""


@query(f"""WITH {T.ENTRIES_SQL}, {ASKED}, {LATEST}, {PREFIXED}, exact AS (SELECT query, id, lema FROM asked JOIN latest ON query = lema_lc WHERE {OFFICIAL}),
prefixed AS (SELECT query, id, lema FROM met WHERE rank <= 20 AND query NOT IN (SELECT query FROM exact)),
unanswered AS (SELECT query FROM asked WHERE trim(query) <> '' AND query NOT IN (SELECT query FROM exact) AND query NOT IN (SELECT query FROM prefixed)),
raw AS (SELECT query, {UNIT} AS v FROM (SELECT query, sha256(query) AS d FROM unanswered)),
near AS (SELECT query, vec_id, list_dot_product(v, CAST(embedding AS DOUBLE[])) / sqrt(list_dot_product(v, v)) AS s FROM raw, embeddings QUALIFY row_number() OVER (PARTITION BY query ORDER BY s DESC, vec_id) <= 10),
semantic AS (SELECT query, id, lema FROM near JOIN entries ON vec_id = doc_id WHERE s >= 0.1 AND {OFFICIAL})
SELECT query, id, lema, 'exact' AS tier FROM exact UNION ALL SELECT query, id, lema, 'prefix' FROM prefixed UNION ALL SELECT query, id, lema, 'semantic' FROM semantic""")
def q_cascade(spark, sf_dir):
    """All three tiers; ids of the test vectors are those of documents."""
    vectors = T.vectors(spark, sf_dir).select("vec_id", F.concat(F.col("vec_id").cast("string"), F.lit("_r1")).alias("doc_id"), F.lit("").alias("lema"), "embedding")
    return R.cascade(asked(spark, sf_dir), narrow(spark, sf_dir), 20, vectors, lambda text: pseudo_vector(text, 64), 0.1)


@query(f"""WITH {T.ENTRIES_SQL}, {LATEST}, hits AS (SELECT vec_id, CASE WHEN vec_id % 3 = 0 THEN lema ELSE 'no such word' END AS word, CASE WHEN vec_id % 3 = 1 THEN CAST(vec_id AS VARCHAR) END AS before FROM embeddings JOIN entries ON vec_id = doc_id)
SELECT vec_id, coalesce(l.id, e.id) AS id, coalesce(l.lema, e.lema) AS lema FROM hits LEFT JOIN latest l ON lower(word) = l.lema_lc LEFT JOIN entries e ON before = e.id WHERE coalesce(l.id, e.id) IS NOT NULL""")
def q_hydration(spark, sf_dir):
    """By word, by what stands before the underscore, or not at all."""
    rows = T.vectors(spark, sf_dir).join(T.entries(spark, sf_dir).select(F.col("doc_id").alias("vec_id"), "lema"), "vec_id")
    hits = rows.select("vec_id", F.when(F.col("vec_id") % 3 == 0, F.concat(F.lit(" "), "lema")).otherwise("no such word").alias("lema"), F.when(F.col("vec_id") % 3 == 1, F.concat(F.col("vec_id").cast("string"), F.lit("_r1"))).otherwise("-").alias("doc_id"))
    return R.hydrated(hits, T.entries(spark, sf_dir)).select("vec_id", "id", "lema")


V_SQL = "v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, label FROM embeddings), q AS (SELECT e AS qe FROM v WHERE vec_id = 0)"


def one_vector(spark: SparkSession, sf_dir: str) -> F.Column:
    """The vector with id 0, as a literal of bounded size."""
    found = T.vectors(spark, sf_dir).where("vec_id = 0").select("embedding").head()
    return F.array(*[F.lit(x) for x in (found[0] if found else [])])


def _knn(measure: str):
    def run(spark, sf_dir):
        return R.nearest(T.vectors(spark, sf_dir).where("vec_id <> 0"), one_vector(spark, sf_dir), 10, measure).select("vec_id", (F.round("distance", 6) + 0.0).alias("distance"))

    return run


for _name, _measure, _sql in (
    ("q_knn_dot", "DOT_PRODUCT", "1 - list_dot_product(e, qe)"), ("q_knn_cosine", "COSINE", "1 - list_cosine_similarity(e, qe)"), ("q_knn_euclid", "EUCLIDEAN", "list_distance(e, qe)"),
):
    _f = _knn(_measure)
    _f.__name__, _f.__doc__ = _name, f"J06, F32, T04: {_measure}."
    query(f"WITH {V_SQL}, d AS (SELECT vec_id, {_sql} AS distance FROM v, q WHERE vec_id <> 0) SELECT vec_id, round(distance, 6) + 0.0 AS distance FROM d ORDER BY d.distance, vec_id LIMIT 10")(_f)


@query(f"""WITH {V_SQL}, d AS (SELECT vec_id, label, 1 - list_dot_product(e, qe) AS distance FROM v, q WHERE label = 1)
SELECT vec_id, label, round(distance, 6) + 0.0 AS distance FROM d ORDER BY d.distance, vec_id LIMIT 10""")
def q_knn_filtered(spark, sf_dir):
    """The filter comes before the top-k."""
    return R.nearest(T.vectors(spark, sf_dir), one_vector(spark, sf_dir), 10, keep=F.col("label") == 1).select("vec_id", "label", (F.round("distance", 6) + 0.0).alias("distance"))


@query(f"""WITH {T.ENTRIES_SQL}, {V_SQL}, d AS (SELECT vec_id, 1 - list_dot_product(e, qe) AS distance FROM v, q ORDER BY distance, vec_id LIMIT 50)
SELECT vec_id, id, lema, round(1 - distance, 6) + 0.0 AS similarity FROM d JOIN entries ON vec_id = doc_id WHERE 1 - distance >= 0.1 AND {OFFICIAL}""")
def q_knn_hydrate(spark, sf_dir):
    """The top-k comes before the filters."""
    hits = R.nearest(T.vectors(spark, sf_dir), one_vector(spark, sf_dir), 50)
    return R.hydrate(hits, T.entries(spark, sf_dir), 0.1).select("vec_id", "id", "lema", (F.round("similarity", 6) + 0.0).alias("similarity"))


@query(f"""WITH {V_SQL}, d AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id, 1 - list_dot_product(a.e, b.e) AS distance FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM d)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, round(distance, 6) + 0.0 AS distance FROM r WHERE rank <= 3""")
def q_knn_batch(spark, sf_dir):
    """Every row whose id is divisible by 50 against all rows."""
    rows = T.vectors(spark, sf_dir)
    asked_vectors = rows.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    return R.nearest_batch(asked_vectors, rows, 3).withColumn("distance", F.round("distance", 6) + 0.0)
