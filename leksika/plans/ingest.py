"""Queries over the ledgers of checkpointed ingest and over event streams read as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leksika.functions import hashing as H
from leksika.operators import checkpoint as C
from leksika.operators import ordered as O
from leksika.operators import validation as V
from leksika.plans.registry import Registry
from leksika.sources import catalogs
from leksika.sources import tables as T
from leksika.streaming import runs

query = Registry()


@query("SELECT CAST(doc_id AS VARCHAR) AS stable_key, CAST(row_number() OVER (ORDER BY CAST(doc_id AS VARCHAR)) - 1 AS INTEGER) AS selected_index FROM documents ORDER BY 1 LIMIT 100")
def q_selection(spark, sf_dir):
    """T01, W04."""
    return C.selection(T.read(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("stable_key")))


def bindings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = T.read(spark, sf_dir, "conversations").withColumn("tier", F.when(F.col("role") == "user", "official").otherwise("evidence"))
    return C.ordered_bindings(rows, "conv_id", F.when(F.col("tier") == "official", 0).otherwise(1), "turn")


BINDINGS = """bindings AS (SELECT conv_id, turn, role, text, CASE WHEN role = 'user' THEN 'official' ELSE 'evidence' END AS tier,
  CAST(row_number() OVER (PARTITION BY conv_id ORDER BY CASE WHEN role = 'user' THEN 0 ELSE 1 END, turn) AS INTEGER) AS sequence FROM conversations)"""


@query(f"WITH {BINDINGS} SELECT conv_id, turn, sequence - 1 AS binding_index, sequence FROM bindings")
def q_binding_order(spark, sf_dir):
    """W02, W03, T10."""
    return bindings(spark, sf_dir).select("conv_id", "turn", "binding_index", "sequence")


@query(f"WITH {BINDINGS} SELECT conv_id, arg_min(turn, sequence) AS turn, min(sequence) AS sequence FROM bindings WHERE tier = 'official' AND length(text) > 20 GROUP BY conv_id")
def q_first_official(spark, sf_dir):
    """W01, X13."""
    accepted = (F.col("tier") == "official") & (F.length("text") > 20)
    return C.first_accepted(bindings(spark, sf_dir), "conv_id", accepted).select("conv_id", "turn", "sequence")


@query(f"""WITH {BINDINGS}, o AS (SELECT conv_id, text, length(text) % 2 AS parity FROM bindings WHERE tier = 'official' QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) = 1)
SELECT conv_id, min(b.turn) AS turn, arg_min((CASE WHEN o.text <> b.text THEN 'text' ELSE '' END) || (CASE WHEN o.parity <> length(b.text) % 2 THEN ',parity' ELSE '' END), b.turn) AS differs
FROM bindings b JOIN o USING (conv_id) WHERE tier = 'evidence' AND o.text <> b.text GROUP BY conv_id""")
def q_official_vs_evidence(spark, sf_dir):
    """J14, J15, W10."""
    rows = bindings(spark, sf_dir).withColumn("parity", F.length("text") % 2)
    return V.official_and_evidence(rows, "conv_id", "tier", ["text", "parity"], "turn").select("conv_id", "turn", F.array_join("differs", ",").alias("differs"))


def status() -> Column:
    """An HTTP status for each kind of event."""
    return F.when(F.col("event_type") == "error", 503).when(F.col("event_type") == "signup", 404).otherwise(200)


def tried(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = T.read(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type", status().alias("status"))
    return C.attempts(rows, "user_id", ["ts", "event_id"], "status")


TRIED = """tried AS (SELECT event_id, user_id, CASE event_type WHEN 'error' THEN 'transient' WHEN 'signup' THEN 'permanent' ELSE 'success' END AS kind,
  CAST(row_number() OVER w - 1 AS INTEGER) AS attempt, count(*) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS cumulative FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))"""


@query(f"WITH {TRIED} SELECT event_id, kind, attempt, cumulative, CASE WHEN kind = 'transient' THEN least(0.5 * pow(2, attempt), 8) END AS wait FROM tried")
def q_attempts_cumulative(spark, sf_dir):
    """W07, F30, P22, A16."""
    return tried(spark, sf_dir).select("event_id", "kind", "attempt", "cumulative", "wait")


@query(f"WITH {TRIED} SELECT user_id, count(*) FILTER (WHERE kind = 'transient' AND attempt >= 3) AS exhausted, max(attempt) AS last_attempt, count(*) FILTER (WHERE kind = 'success') AS reads FROM tried GROUP BY user_id")
def q_retry_exhausted(spark, sf_dir):
    """W12, ST06, A20."""
    return tried(spark, sf_dir).groupBy("user_id").agg(F.count_if("exhausted").alias("exhausted"), F.max("attempt").alias("last_attempt"), F.count_if(F.col("kind") == "success").alias("reads"))


@query("""WITH p AS (SELECT user_id, event_id, CASE event_type WHEN 'purchase' THEN 'accepted' WHEN 'error' THEN 'conflict' WHEN 'signup' THEN 'retryable' ELSE 'failed' END AS outcome, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS sequence FROM events),
l AS (SELECT user_id, count(*) AS attempt_count, arg_min(event_id, sequence) AS first_attempt, arg_max(event_id, sequence) AS last_attempt, CASE WHEN bool_or(outcome = 'accepted') THEN 'accepted' WHEN bool_or(outcome = 'conflict') THEN 'conflict' WHEN bool_or(outcome = 'retryable') THEN 'retryable' ELSE arg_max(outcome, sequence) END AS outcome,
  min('c' || CAST(event_id AS VARCHAR)) FILTER (WHERE outcome = 'conflict') AS conflict_id FROM p GROUP BY user_id)
SELECT user_id, attempt_count, first_attempt, last_attempt, l.outcome AS outcome, conflict_id, CAST((sequence - 1) // 10 AS INTEGER) AS part, string_agg(CAST(event_id AS VARCHAR) || ':' || p.outcome || ':' || CASE WHEN p.outcome = 'conflict' THEN conflict_id ELSE '' END, ',' ORDER BY sequence) AS source_attempts
FROM p JOIN l USING (user_id) GROUP BY user_id, attempt_count, first_attempt, last_attempt, l.outcome, conflict_id, (sequence - 1) // 10""")
def q_logical_attempts(spark, sf_dir):
    """Each user's events as attempts of a key, ten to a list."""
    kind, name = F.col("event_type"), F.concat(F.lit("c"), F.col("event_id").cast("string"))
    physical = T.read(spark, sf_dir, "events").select(
        "user_id", "ts", "event_id", F.when(kind == "purchase", "accepted").when(kind == "error", "conflict").when(kind == "signup", "retryable").otherwise("failed").alias("outcome"), F.when(kind == "error", name).alias("conflict_id"),
    )
    logical, nested = C.logical_attempts(physical, "user_id", ["ts", "event_id"], "event_id", "outcome", "conflict_id", 10)
    line = lambda a: F.concat_ws(":", a["event_id"].cast("string"), a["outcome"], F.coalesce(a["conflict_id"], F.lit("")))
    listed = nested.select("user_id", "part", F.array_join(F.transform("source_attempts", line), ",").alias("source_attempts"))
    return logical.drop("parts").join(listed, "user_id")


def outcome() -> Column:
    """An outcome for each kind of event."""
    return F.when(F.col("event_type") == "purchase", "accepted").when(F.col("event_type") == "error", "retryable").when(F.col("event_type") == "signup", "failed").otherwise("pending")


OUTCOME_SQL = "CASE event_type WHEN 'purchase' THEN 'accepted' WHEN 'error' THEN 'retryable' WHEN 'signup' THEN 'failed' ELSE 'pending' END"


@query(f"""WITH o AS (SELECT {OUTCOME_SQL} AS outcome FROM events), c AS (SELECT unnest(['accepted', 'conflict', 'quarantined', 'retryable', 'failed', 'excluded', 'pending']) AS outcome)
SELECT c.outcome AS outcome, count(o.outcome) AS n FROM c LEFT JOIN o ON c.outcome = o.outcome GROUP BY 1""")
def q_outcome_counts(spark, sf_dir):
    """A01."""
    return C.outcome_counts(T.read(spark, sf_dir, "events").select(outcome().alias("outcome")))


@query(f"""WITH o AS (SELECT {OUTCOME_SQL} AS outcome FROM events), a AS (SELECT count(*) FILTER (WHERE outcome IN ('accepted', 'failed')) AS terminal, count(*) FILTER (WHERE outcome NOT IN ('accepted', 'failed')) AS pending,
  bool_or(outcome = 'retryable') AS blocked FROM o)
SELECT terminal, pending, pending = 0 AS complete, blocked, pending = 0 AND NOT blocked AS eligible, CASE WHEN pending > 0 AND blocked THEN 'incomplete,retryable' WHEN pending > 0 THEN 'incomplete' ELSE '' END AS reasons FROM a""")
def q_completion(spark, sf_dir):
    """A02, A03, A04."""
    return C.completion(T.read(spark, sf_dir, "events").select(outcome().alias("outcome"))).withColumn("reasons", F.array_join("reasons", ","))


@query("""WITH s AS (SELECT doc_id FROM documents WHERE doc_id % 3 = 0), o AS (SELECT doc_id FROM labels)
SELECT (SELECT count(*) FROM o) AS rows, (SELECT count(DISTINCT doc_id) FROM o) AS keys, (SELECT count(DISTINCT doc_id) FROM o WHERE doc_id NOT IN (SELECT doc_id FROM s)) AS extra,
  (SELECT count(*) FROM s WHERE doc_id NOT IN (SELECT doc_id FROM o)) AS missing, false AS conserved""")
def q_conservation(spark, sf_dir):
    """A05, U-S5, U-S7, U-S8."""
    return C.conservation(T.read(spark, sf_dir, "documents").where("doc_id % 3 = 0").select("doc_id"), T.read(spark, sf_dir, "labels").select("doc_id"), "doc_id")


@query(f"""WITH leaf AS (SELECT CAST(doc_id AS VARCHAR) AS k, sha256(source || '|' || lang) AS h FROM documents), {O.TREE_SQL} SELECT n, fingerprint FROM tree""")
def q_catalog_fingerprint(spark, sf_dir):
    """A10, A11, P06."""
    rows = T.read(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("k"), "source", "lang")
    return C.fingerprint(rows, "k", F.concat_ws("|", "source", "lang"))


@query(f"""WITH leaf AS (SELECT CAST(doc_id AS VARCHAR) AS k, sha256(text) AS h FROM documents), {O.TREE_SQL} SELECT n, fingerprint FROM tree""")
def q_corpus_digest(spark, sf_dir):
    """A08."""
    return C.fingerprint(T.read(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("k"), "text"), "k", F.col("text"))


@query("""SELECT count(*) AS n, sha256(string_agg('{"id":' || CAST(to_json(CAST(doc_id AS VARCHAR)) AS VARCHAR) || ',"lang":' || CAST(to_json(lang) AS VARCHAR) || '}', chr(10) ORDER BY CAST(doc_id AS VARCHAR))) AS digest FROM documents""")
def q_line_digest(spark, sf_dir):
    """The digest of all canonical lines in order of id."""
    rows = T.read(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), "lang")
    return O.line_digest(rows, "id", line=H.canonical_json({"id": F.col("id"), "lang": F.col("lang")}))


@query("""WITH r AS (SELECT doc_id, string_agg(s, ',' ORDER BY s) AS reviews, bool_or(s = 'open') AS blocked FROM (
  SELECT doc_id, CASE WHEN toxic = 1 THEN 'open' ELSE 'resolved' END AS s FROM labels UNION ALL SELECT doc_id, CASE WHEN quality = 0 THEN 'open' ELSE 'resolved' END FROM labels) GROUP BY doc_id)
SELECT doc_id, coalesce(reviews, '') AS reviews, coalesce(blocked, false) AS blocked FROM documents LEFT JOIN r USING (doc_id)""")
def q_reviews_join(spark, sf_dir):
    """J16, P25."""
    labels = T.read(spark, sf_dir, "labels")
    reviews = labels.select("doc_id", F.when(F.col("toxic") == 1, "open").otherwise("resolved").alias("s")).unionAll(labels.select("doc_id", F.when(F.col("quality") == 0, "open").otherwise("resolved").alias("s")))
    return C.with_reviews(T.read(spark, sf_dir, "documents").select("doc_id"), reviews, "doc_id", "s").withColumn("reviews", F.array_join("reviews", ","))


@query("SELECT c_custkey, count(o_orderkey) AS matches, count(o_orderkey) = 1 AS exactly_one FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey")
def q_exactly_one(spark, sf_dir):
    """J17."""
    orders = T.read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return C.exactly_one(T.read(spark, sf_dir, "customer").select("c_custkey"), orders, "c_custkey")


@query("""WITH d AS (SELECT doc_id, sha256(text) AS h FROM documents)
SELECT coalesce(CASE WHEN doc_id % 11 = 0 THEN 'attempt_missing' WHEN doc_id % 7 = 0 THEN 'observation_missing' WHEN doc_id % 5 = 0 THEN 'raw_hash_mismatch' WHEN doc_id % 3 = 0 THEN 'artifact_hash_mismatch' END, 'sound') AS reason, count(*) AS n FROM d GROUP BY 1""")
def q_lineage(spark, sf_dir):
    """J18-J29, P24, P29."""
    docs = T.read(spark, sf_dir, "documents").select("doc_id", "text", H.sha256(F.col("text")).alias("h"))
    key = F.col("doc_id").cast("string")
    outcomes = docs.select("doc_id", F.concat(F.lit("a"), key).alias("attempt_id"), F.concat(F.lit("o"), key).alias("observation_id"), F.col("h").alias("canonical_hash"))
    attempts = docs.where("doc_id % 11 <> 0").select(F.concat(F.lit("a"), key).alias("attempt_id"), "doc_id")
    observations = docs.where("doc_id % 7 <> 0").select(F.concat(F.lit("o"), key).alias("observation_id"), F.concat(F.lit("r"), key).alias("raw_snapshot_id"))
    raws = docs.select(F.concat(F.lit("r"), key).alias("raw_snapshot_id"), F.when(F.col("doc_id") % 5 == 0, "other").otherwise(F.col("text")).alias("content"), F.col("h").alias("raw_sha256"))
    artifacts = docs.select("doc_id", F.when(F.col("doc_id") % 3 == 0, "other").otherwise(F.col("h")).alias("artifact_hash"))
    return C.lineage(outcomes, attempts, observations, raws, artifacts, ["doc_id"]).groupBy(F.coalesce("reason", F.lit("sound")).alias("reason")).agg(F.count("*").alias("n"))


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def q_stream_tumbling(spark, sf_dir):
    """2.K: tumbling windows."""
    return runs.tumbling(T.read(spark, sf_dir, "events")).withColumn("total", F.round("total", 4))


@query("WITH b AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS s FROM events), w AS (SELECT s AS start FROM b UNION ALL SELECT s - INTERVAL 1 HOUR FROM b) SELECT start, count(*) AS n FROM w GROUP BY start")
def q_stream_sliding(spark, sf_dir):
    """2.K: sliding windows."""
    return runs.sliding(T.read(spark, sf_dir, "events"))


@query("""WITH g AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER w + INTERVAL 30 MINUTES THEN 0 ELSE 1 END AS first FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT user_id, ts, sum(first) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM g)
SELECT user_id, min(ts) AS start, count(*) AS n FROM s GROUP BY user_id, session""")
def q_stream_session(spark, sf_dir):
    """2.K: session windows."""
    return runs.sessions(T.read(spark, sf_dir, "events"))


@query("SELECT DISTINCT user_id, event_type FROM events")
def q_stream_dedup(spark, sf_dir):
    """2.K: repeats dropped."""
    rows = T.read(spark, sf_dir, "events").withColumn("key", F.concat_ws("|", "user_id", "event_type"))
    return runs.without_repeats(rows, "key").select("user_id", "event_type")


@query("""WITH l AS (SELECT user_id, event_type, row_number() OVER w AS n, lag(event_type) OVER w AS previous FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, coalesce(min(n) FILTER (WHERE event_type = 'purchase'), 0) AS completed_at, count(*) FILTER (WHERE event_type = 'error' AND previous = 'error') AS repeated_errors, CASE WHEN bool_or(event_type = 'purchase') THEN 'completed' ELSE 'running' END AS state FROM l GROUP BY user_id""")
def q_lifecycle(spark, sf_dir):
    """ST01 over an ordered log."""
    from pyspark.sql.window import Window

    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    rows = T.read(spark, sf_dir, "events").select("user_id", "event_type", F.row_number().over(order).alias("n"), F.lag("event_type").over(order).alias("previous"))
    bought = F.col("event_type") == "purchase"
    return rows.groupBy("user_id").agg(
        F.coalesce(F.min(F.when(bought, F.col("n"))), F.lit(0)).cast("long").alias("completed_at"), F.count_if((F.col("event_type") == "error") & (F.col("previous") == "error")).alias("repeated_errors"),
        F.when(F.bool_or(bought), "completed").otherwise("running").alias("state"),
    )


CATALOG_SQL = """kept AS (SELECT doc_id, 'kata-' || doc_id AS k, doc_id % 8 AS n, lower(coalesce(lang, 'id')) AS l, sha256(coalesce(text, '')) AS h FROM documents)"""


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog entry for each document: sources of two hosts and others, and two observations, in some entries one twice."""
    n, key = F.col("doc_id") % 8, F.concat(F.lit("kata-"), F.col("doc_id").cast("string"))
    host = F.when(n.isin(1, 2), "kbbi.web.id").when(n == 3, "example.org").otherwise("kbbi.kemdikbud.go.id")
    digest = H.sha256(F.coalesce("text", F.lit("")))

    def source(url: Column, kind: Column, edition: str) -> Column:
        return F.struct(url.alias("url"), kind.alias("source_kind"), F.lit(edition).alias("edition"), digest.alias("content_hash"))

    page = F.concat(F.lit("https://"), host, F.lit("/entri/"), F.when(n == 4, F.lit("lain")).otherwise(key))
    primary = source(page, F.when(n == 2, "fallback").otherwise("official-live"), "VI")
    transport = F.struct(F.lit("fixture").alias("adapter"), F.coalesce("text", F.lit("")).alias("content"), digest.alias("expected_raw_hash"))
    seen = lambda place, role: F.struct(F.lit(role).alias("role"), source(F.concat(F.lit("https://kbbi.web.id/"), place, F.lit("/"), key), F.lit("fallback"), "V").alias("source_ref"))
    first, second = F.lower(F.coalesce("lang", F.lit("id"))), F.when(n == 5, F.lower(F.coalesce("lang", F.lit("id")))).otherwise("2")
    entry = F.struct(F.upper(key).alias("stableKey"), primary.alias("source"), transport.alias("transport"), F.array(seen(first, "official"), seen(second, "evidence")).alias("observations"))
    return T.read(spark, sf_dir, "documents").select(F.lit("c").alias("catalog_id"), F.to_json(entry).alias("payload"))


@query(f"""WITH {CATALOG_SQL} SELECT k AS stable_key, CASE n WHEN 1 THEN 'unofficial_host' WHEN 3 THEN 'unapproved_host' WHEN 4 THEN 'url_mismatch' WHEN 5 THEN 'repeated_observation' END AS reason FROM kept""")
def q_catalog_records(spark, sf_dir):
    """S06-S10, P23, U-S10: entries with the first reason against them: aliases, hosts, addresses, repeated observations."""
    return catalogs.records(catalog(spark, sf_dir)).select("stable_key", "reason")


@query(f"""WITH {CATALOG_SQL}, ok AS (SELECT * FROM kept WHERE n NOT IN (1, 3, 4, 5))
SELECT k AS stable_key, 0 AS place, 'primary' AS role, 'https://' || CASE WHEN n = 2 THEN 'kbbi.web.id' ELSE 'kbbi.kemdikbud.go.id' END || '/entri/' || k AS url, h AS content_hash FROM ok
UNION ALL SELECT k, 1, 'evidence', 'https://kbbi.web.id/2/' || k, h FROM ok UNION ALL SELECT k, 2, 'official', 'https://kbbi.web.id/' || l || '/' || k, h FROM ok""")
def q_catalog_bindings(spark, sf_dir):
    """The bindings of valid entries in order of their seven keys."""
    valid = catalogs.records(catalog(spark, sf_dir)).where("reason is null")
    return catalogs.bindings(valid).select("stable_key", "place", "role", F.col("source.url").alias("url"), F.col("source.content_hash").alias("content_hash"))
