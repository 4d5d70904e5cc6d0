"""Queries that validate entries, plan releases and check them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leksika.functions import hashing as H
from leksika.functions.vectors import norm
from leksika.operators import ordered as O
from leksika.operators import releases as L
from leksika.operators import validation as V
from leksika.plans.registry import Registry
from leksika.sources import tables as T

query = Registry()


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries with review status, and why they may not enter the canonical corpus."""
    reviews = T.reviews(spark, sf_dir)
    rows = T.entries(spark, sf_dir).join(reviews, "doc_id", "left").withColumn("review_status", F.coalesce("review_status", F.lit("pending")))
    rows = rows.withColumn("content_hash", H.sha256(F.col("definisi"))).withColumn("makna", F.when(F.col("n_chars") >= 50, F.array("definisi")).otherwise(F.array().cast("array<string>")))
    rows = rows.withColumn("parser_version", F.when(F.col("doc_id") % 13 == 0, "0.0.9").otherwise("0.1.0")).withColumn("source_parser_version", F.lit("0.1.0"))
    return rows.withColumn("reason", V.entry_failure(H.sha256(F.when(F.col("doc_id") % 17 == 0, "tampered").otherwise(F.col("definisi")))))


JUDGED = f"""{T.ENTRIES_SQL}, {T.REVIEWS_SQL}, judged AS (
  SELECT e.*, coalesce(r.review_status, 'pending') AS review_status,
    CASE WHEN source_kind NOT IN ('official-live', 'official-snapshot') THEN 'authority_violation' WHEN n_chars < 50 THEN 'empty_makna'
      WHEN doc_id % 17 = 0 THEN 'hash_mismatch' WHEN doc_id % 13 = 0 THEN 'parser_version_mismatch' END AS reason
  FROM entries e LEFT JOIN reviews r USING (doc_id))"""


@query(f"WITH {JUDGED} SELECT coalesce(reason, 'valid') AS reason, count(*) AS n FROM judged GROUP BY 1")
def q_validate_ladder(spark, sf_dir):
    """P14, P15, F50."""
    return judged(spark, sf_dir).groupBy(F.coalesce("reason", F.lit("valid")).alias("reason")).agg(F.count("*").alias("n"))


@query(f"WITH {JUDGED} SELECT id, reason, source_kind, review_status FROM judged WHERE reason IS NOT NULL")
def q_quarantine_queue(spark, sf_dir):
    """K11, T08."""
    return judged(spark, sf_dir).where("reason is not null").select("id", "reason", "source_kind", "review_status")


@query(f"WITH {T.ENTRIES_SQL} SELECT source_kind, count(*) AS n, source_kind LIKE 'official-%' AS canonical, count(*) FILTER (WHERE status = 'active') AS active FROM entries GROUP BY source_kind")
def q_authority(spark, sf_dir):
    """P15, F50."""
    rows = T.entries(spark, sf_dir)
    return rows.groupBy("source_kind").agg(F.count("*").alias("n"), F.bool_and(V.canonical_writer(F.col("source_kind"))).alias("canonical"), F.count_if(F.col("status") == "active").alias("active"))


def sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Prior and candidate release: id, hash."""
    docs = T.read(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").cast("string").alias("id"), "text")
    changed = F.when(F.col("doc_id") % 7 == 0, F.concat(F.col("text"), F.lit("!"))).otherwise(F.col("text"))
    return docs.where("doc_id % 10 < 8").select("id", H.sha256(F.col("text")).alias("hash")), docs.where("doc_id % 10 > 1").select("id", H.sha256(changed).alias("hash"), changed.alias("document"))


SIDES = """prior AS (SELECT CAST(doc_id AS VARCHAR) AS id, sha256(text) AS hash FROM documents WHERE doc_id % 10 < 8),
candidate AS (SELECT CAST(doc_id AS VARCHAR) AS id, sha256(CASE WHEN doc_id % 7 = 0 THEN text || '!' ELSE text END) AS hash FROM documents WHERE doc_id % 10 > 1),
plan AS (SELECT coalesce(p.id, c.id) AS id, CASE WHEN p.id IS NULL THEN 'new' WHEN c.id IS NULL THEN 'removed' WHEN p.hash = c.hash THEN 'unchanged' ELSE 'changed' END AS class,
  p.hash AS old_hash, c.hash AS new_hash FROM prior p FULL OUTER JOIN candidate c ON p.id = c.id)"""


@query(f"WITH {SIDES} SELECT * FROM plan")
def q_delta_plan(spark, sf_dir):
    """J09."""
    return L.delta_plan(*sides(spark, sf_dir))


@query(f"""WITH {SIDES} SELECT count(*) FILTER (WHERE class = 'new') AS new, count(*) FILTER (WHERE class = 'changed') AS changed, count(*) FILTER (WHERE class = 'unchanged') AS unchanged,
  count(*) FILTER (WHERE class = 'removed') AS removed, CAST(0 AS BIGINT) AS excluded, count(*) FILTER (WHERE class IN ('new', 'changed')) AS provider_calls, count(*) = count(DISTINCT id) AS conserved FROM plan""")
def q_delta_counts(spark, sf_dir):
    """A06, A13, A14."""
    return L.class_counts(L.delta_plan(*sides(spark, sf_dir)))


@query(f"WITH {SIDES} SELECT id FROM candidate EXCEPT SELECT id FROM prior")
def q_set_new(spark, sf_dir):
    """U-S1."""
    prior, candidate = sides(spark, sf_dir)
    return candidate.select("id").subtract(prior.select("id"))


@query(f"WITH {SIDES} SELECT id FROM prior EXCEPT SELECT id FROM candidate")
def q_set_removed(spark, sf_dir):
    """U-S1."""
    prior, candidate = sides(spark, sf_dir)
    return prior.select("id").subtract(candidate.select("id"))


@query(f"WITH {SIDES} SELECT id FROM prior INTERSECT SELECT id FROM candidate")
def q_set_common(spark, sf_dir):
    """U-S2."""
    prior, candidate = sides(spark, sf_dir)
    return prior.select("id").intersect(candidate.select("id"))


@query(f"WITH {SIDES} SELECT id FROM prior UNION SELECT id FROM candidate")
def q_set_union(spark, sf_dir):
    """U-S3, U-S4."""
    prior, candidate = sides(spark, sf_dir)
    return prior.select("id").union(candidate.select("id")).distinct()


@query(f"""WITH {SIDES}, stored AS (SELECT CAST(vec_id AS VARCHAR) AS id FROM embeddings)
SELECT class, s.id IS NOT NULL AND class = 'unchanged' AS reused, count(*) AS n FROM plan p LEFT JOIN stored s ON p.id = s.id WHERE class <> 'removed' GROUP BY ALL""")
def q_reuse(spark, sf_dir):
    """J11, J12, J13, A14."""
    prior, candidate = sides(spark, sf_dir)
    stored = T.vectors(spark, sf_dir).select(F.col("vec_id").cast("string").alias("id"), "embedding")
    built = L.built_vectors(L.delta_plan(prior, candidate), candidate, stored, 64)
    return built.groupBy("class", "reused").agg(F.count("*").alias("n"))


@query("SELECT sha256(text) AS hash, count(*) AS copies, count(DISTINCT lang) > 1 AS conflict FROM documents GROUP BY 1 HAVING count(*) > 1")
def q_dedup_conflict(spark, sf_dir):
    """A17."""
    rows = T.read(spark, sf_dir, "documents").select(H.sha256(F.col("text")).alias("hash"), "lang")
    return L.deduplicated(rows, "hash", "lang").where("copies > 1").select("hash", "copies", "conflict")


@query("WITH c AS (SELECT CAST(floor((row_number() OVER (ORDER BY doc_id) - 1) / 500) AS BIGINT) AS chunk FROM documents) SELECT chunk, count(*) AS n FROM c GROUP BY chunk")
def q_chunks(spark, sf_dir):
    """W06, A15, K05."""
    return L.chunks(T.read(spark, sf_dir, "documents").select("doc_id"), "doc_id").groupBy("chunk").agg(F.count("*").alias("n"))


@query("""WITH b AS (SELECT doc_id, sha256(text) AS hash FROM documents WHERE doc_id % 3 = 0), h AS (SELECT doc_id, sha256(CASE WHEN doc_id % 5 = 0 THEN lang ELSE text END) AS hash FROM documents WHERE doc_id % 2 = 0)
SELECT CASE WHEN h.doc_id IS NULL THEN 'write' WHEN h.hash = b.hash THEN 'no-op' ELSE 'conflict' END AS action, count(*) AS n FROM b LEFT JOIN h USING (doc_id) GROUP BY 1""")
def q_preflight(spark, sf_dir):
    """J25, K03, K06."""
    docs = T.read(spark, sf_dir, "documents")
    batch = docs.where("doc_id % 3 = 0").select("doc_id", H.sha256(F.col("text")).alias("hash"))
    have = docs.where("doc_id % 2 = 0").select("doc_id", H.sha256(F.when(F.col("doc_id") % 5 == 0, F.col("lang")).otherwise(F.col("text"))).alias("hash"))
    return L.preflight(batch, have, "doc_id").groupBy("action").agg(F.count("*").alias("n"))


@query(f"""WITH {T.ENTRIES_SQL}, leaf AS (SELECT id AS k, sha256(id || ':' || sha256(definisi)) AS h FROM entries), {O.TREE_SQL}
SELECT count(*) AS entries, count(*) FILTER (WHERE status = 'active') AS active, count(*) FILTER (WHERE status = 'inactive') AS inactive, (SELECT fingerprint FROM tree) AS digest FROM entries""")
def q_manifest_agg(spark, sf_dir):
    """A07, A09."""
    return L.manifest(T.entries(spark, sf_dir).withColumn("hash", H.sha256(F.col("definisi"))), "id", "hash", "status")


@query("""WITH e AS (SELECT doc_id FROM documents), a AS (SELECT vec_id AS doc_id FROM embeddings WHERE vec_id % 3 > 0)
SELECT doc_id, 'missing' AS problem FROM e WHERE doc_id NOT IN (SELECT doc_id FROM a) UNION ALL SELECT doc_id, 'extra' FROM a WHERE doc_id NOT IN (SELECT doc_id FROM e)""")
def q_missing_extra(spark, sf_dir):
    """J30, U-S6."""
    expected = T.read(spark, sf_dir, "documents").select("doc_id")
    actual = T.vectors(spark, sf_dir).where("vec_id % 3 > 0").select(F.col("vec_id").alias("doc_id"))
    return L.missing_and_extra(expected, actual, "doc_id")


@query("""SELECT vec_id, array_to_string(list_filter([CASE WHEN vec_id % 5 = 0 THEN 'dimensions' END, CASE WHEN vec_id % 7 = 0 THEN 'not_finite' END, CASE WHEN vec_id % 3 = 0 THEN 'content_hash' END, CASE WHEN vec_id % 11 = 0 THEN 'version' END,
  CASE WHEN vec_id % 13 = 0 THEN 'source_kind' END, CASE WHEN vec_id % 4 = 1 THEN 'task' END], lambda x: x IS NOT NULL), ',') AS violations,
  round(sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))), 5) AS norm FROM embeddings""")
def q_vector_checks(spark, sf_dir):
    """Records broken in different ways, and the norms of the sound vectors."""
    n = F.col("vec_id")
    rows = T.vectors(spark, sf_dir).select(
        "vec_id", norm(F.col("embedding")).alias("norm"),
        F.when(n % 5 == 0, F.slice("embedding", 1, 63)).otherwise(F.col("embedding")).alias("embedding"), F.when(n % 11 == 0, "r0").otherwise("r1").alias("version"),
        F.when(n % 3 == 0, "ABC").otherwise(F.sha2(n.cast("string"), 256)).alias("content_hash"), F.when(n % 13 == 0, "").otherwise("official-live").alias("source_kind"),
        F.when(n % 4 == 1, "RETRIEVAL_QUERY").when(n % 4 == 2, V.TASK).alias("task"),
    )
    rows = rows.withColumn("embedding", F.when(n % 7 == 0, F.transform("embedding", lambda x, i: F.when(i == 1, float("nan")).otherwise(x))).otherwise(F.col("embedding")))
    return rows.select("vec_id", F.array_join(V.vector_violations(64, "r1", ("source_kind", "task")), ",").alias("violations"), F.round("norm", 5).alias("norm"))


@query("""WITH b AS (SELECT doc_id, sha256(text) AS hash FROM documents), h AS (SELECT doc_id, hash FROM b WHERE doc_id % 2 = 0),
c AS (SELECT b.doc_id, h.doc_id IS NULL AS is_new, CAST(floor((row_number() OVER (ORDER BY b.doc_id) - 1) / 500) AS BIGINT) AS chunk FROM b LEFT JOIN h USING (doc_id)), f AS (SELECT max(chunk) // 2 AS failing FROM c)
SELECT chunk, count(*) AS size, count(*) FILTER (WHERE is_new) AS written, min(doc_id) AS first, max(doc_id) AS last, CASE WHEN chunk < failing THEN 'committed' WHEN chunk = failing THEN 'failed' ELSE 'open' END AS status FROM c, f GROUP BY chunk, failing""")
def q_batch_ledger(spark, sf_dir):
    """K05, A15, W06, J25, ST07: documents as one batch, half of them there already, a chunk of which fails."""
    batch = T.read(spark, sf_dir, "documents").select("doc_id", H.sha256(F.col("text")).alias("hash"))
    judged = L.preflight(batch, batch.where("doc_id % 2 = 0"), "doc_id")
    return L.batch_ledger(judged, "doc_id", fail_chunk=(batch.count() - 1) // L.CHUNK // 2)[1]


@query("""WITH b AS (SELECT lang AS id, sha256(text) AS hash FROM documents), c AS (SELECT id, count(DISTINCT hash) > 1 AS apart FROM b GROUP BY id)
SELECT id, CASE WHEN apart THEN 'conflict' ELSE 'write' END AS action FROM c""")
def q_batch_conflicts(spark, sf_dir):
    """Rows of one batch that have one key and different content."""
    batch = T.read(spark, sf_dir, "documents").select(F.col("lang").alias("id"), H.sha256(F.col("text")).alias("hash"))
    return L.preflight(batch, batch.where("false")).select("id", "action")


@query("SELECT user_id, count(*) AS decisions, arg_max(event_type, event_id) AS decision FROM events GROUP BY user_id")
def q_review_state(spark, sf_dir):
    """ST09, S21."""
    return V.review_state(T.read(spark, sf_dir, "events"), "user_id", "event_id", "event_type").select("user_id", "decisions", "decision")


@query("""WITH c AS (SELECT o_custkey, o_orderkey, lag(o_orderkey) OVER w AS previous, CAST(row_number() OVER w AS INTEGER) AS generation FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))
SELECT o_custkey, o_orderkey, previous, generation FROM c""")
def q_pointer_chain(spark, sf_dir):
    """W11, ST10."""
    rows = T.read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.struct("o_orderdate", "o_orderkey").alias("at"), F.lit(None).cast("long").alias("from"))
    return L.pointer_chain(rows, ["o_custkey"], "at", "from", "o_orderkey").select("o_custkey", "o_orderkey", "previous", "generation")
