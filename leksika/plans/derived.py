"""Queries that call operators on what the test tables are made into: markup and JSON built from words, ledgers, reviews, releases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leksika.functions import hashing as H
from leksika.functions import text as X
from leksika.operators import checkpoint, drivers, parsing, releases, replays, reviews, validation
from leksika.operators import retrieval as R
from leksika.plans import workflows
from leksika.plans.registry import Registry
from leksika.session import written
from leksika.sources import tables as T
from leksika.streaming import runs

query = Registry()


def pieces(template: str) -> list[tuple[str, str]]:
    """The fixed texts of a template and the word (w1 to w6, or none) that stands before each."""
    first, *rest = template.split("{w")
    return [("", first), *((f"w{piece[0]}", piece[2:]) for piece in rest)]


def built(template: str) -> Column:
    return F.concat(*[c for word, text in pieces(template) for c in ([F.col(word)] if word else []) + [F.lit(text)]])


HTML = """<html><head><title>{w1} - kamus</title></head><body><nav><ol><li>skip this item</li></ol></nav><div class="lema">{w1} 2</div><span class="kelas">n, v</span>
<div class="makna"><ol><li>1. {w2} {w3} contoh: {w4}</li><li>2) {w5} <i>contoh: {w6} {w2}</i></li></ol></div><p class="tidak-baku">Bentuk tidak baku: {w3}, {w4}.</p><script>var x = "<h1>no</h1>";</script></body></html>"""
BARE = """<html><body><h1>{w2}</h1><ul><li>{w3} {w4} {w5}</li></ul><p>bentuk tidak baku {w6}</p></body></html>"""
JSON = """{"Lema": "{w1}", "definisi": [{"makna": "{w2} {w3}"}, "{w4}"], "kelas": "n; v", "contoh": ["{w5}"], "varian": "{w6}, {w2}"}"""
LISTED = """[{"lema": "-", "makna": "no"}, {"lemma": "no", "kata": "{w1}", "definisi": "no", "arti": {"senses": [{"no": 1, "Makna": "{w2} {w3}"}, "{w4}"]}, "pos": "n; v", "kalimat": [{"sentence": "{w5}"}], "varian": "no", "tidakBaku": "{w6}, {w2}"}]"""
BROKEN = """{"lema": "{w1}" <h1>{w1} {w2}</h1><div class="arti">{w3} {w4} {w5} {w6}</div>"""
KINDS = ((HTML, 0), (BARE, 1), (JSON, 2), (BROKEN, 3))
WORDS_SQL = "words AS (SELECT doc_id, w[1] AS w1, w[2] AS w2, w[3] AS w3, w[4] AS w4, w[5] AS w5, w[6] AS w6 FROM (SELECT doc_id, regexp_extract_all(lower(text), '[a-z]{3,}') AS w FROM documents) WHERE len(w) >= 6)"
ENTRY_SQL = """entry AS (SELECT doc_id, CASE doc_id % 4 WHEN 1 THEN w2 WHEN 3 THEN w1 || ' ' || w2 ELSE w1 END AS lema,
  CASE doc_id % 4 WHEN 0 THEN ['n', 'v'] WHEN 2 THEN ['n', 'v'] ELSE [] END AS kelas,
  CASE doc_id % 4 WHEN 0 THEN [w2 || ' ' || w3, w5] WHEN 1 THEN [w3 || ' ' || w4 || ' ' || w5] WHEN 2 THEN [w2 || ' ' || w3, w4] ELSE [w3 || ' ' || w4 || ' ' || w5 || ' ' || w6] END AS makna,
  CASE doc_id % 4 WHEN 0 THEN [w6 || ' ' || w2] WHEN 2 THEN [w5] ELSE [] END AS contoh,
  CASE doc_id % 4 WHEN 0 THEN [w3, w4] WHEN 1 THEN [w6] WHEN 2 THEN [w6, w2] ELSE [] END AS varian FROM words)"""


def worded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id and six words of each text that has as many."""
    found = F.regexp_extract_all(F.lower("text"), F.lit("([a-z]{3,})"), 1)
    rows = T.read(spark, sf_dir, "documents").select("doc_id", found.alias("w")).where(F.size("w") >= 6)
    return rows.select("doc_id", *[F.get("w", F.lit(i)).alias(f"w{i + 1}") for i in range(6)])


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw snapshots: markup in two forms, JSON as an object or a list, with one name or two for a field, and JSON that is broken and so read as markup."""
    content = F.lit(None).cast("string")
    for template, n in KINDS:
        content = F.when(F.col("doc_id") % 4 == n, built(template)).otherwise(content)
    content = F.when(F.col("doc_id") % 8 == 6, built(LISTED)).otherwise(content)
    rows = worded(spark, sf_dir).withColumn("text", content)
    return rows.select(
        "doc_id", F.col("doc_id").cast("string").alias("raw_snapshot_id"), F.encode("text", "UTF-8").alias("content"), F.concat(F.lit("https://example.org/entri/"), "w1").alias("url"), H.sha256(F.col("text")).alias("raw_sha256")
    )


@query(f"""WITH {WORDS_SQL}, {ENTRY_SQL} SELECT CAST(doc_id AS VARCHAR) AS raw_snapshot_id, replace(lema, ' ', '-') AS id, lema, array_to_string(kelas, '|') AS kelas_kata, array_to_string(makna, '|') AS makna,
  array_to_string(contoh, '|') AS contoh, (SELECT string_agg(v, '|' ORDER BY v) FROM (SELECT DISTINCT unnest(varian) AS v)) AS bentuk_tidak_baku, CAST(NULL AS VARCHAR) AS error FROM entry""")
def q_parse(spark, sf_dir):
    """Whatever a snapshot holds, as an entry."""
    found = parsing.parse(snapshots(spark, sf_dir).select("raw_snapshot_id", "content", "url"))
    lists = {c: F.array_join(c, "|") for c in ("kelas_kata", "makna", "contoh")}
    variants = F.array_join(F.array_sort(F.array_distinct("bentuk_tidak_baku")), "|")
    return found.withColumns(lists).select("raw_snapshot_id", "id", "lema", "kelas_kata", "makna", "contoh", F.nullif(variants, F.lit("")).alias("bentuk_tidak_baku"), "error")


@query(f"""WITH {WORDS_SQL} SELECT CASE WHEN doc_id % 9 = 0 THEN 'raw_hash_mismatch' WHEN doc_id % 5 = 0 THEN 'not_stored' WHEN doc_id % 7 = 0 THEN 'entry_mismatch' ELSE 'same' END AS reason, count(*) AS n FROM words GROUP BY 1""")
def q_replay(spark, sf_dir):
    """Snapshots parsed again, some of them or of the stored entries changed since."""
    raw = written(snapshots(spark, sf_dir), "snapshots")
    stored = parsing.parse(raw.where("doc_id % 5 <> 0").select("raw_snapshot_id", "content", "url"))
    stored = stored.withColumn("lema", F.when(F.col("raw_snapshot_id").cast("long") % 7 == 0, "other").otherwise(F.col("lema")))
    changed = raw.withColumn("raw_sha256", F.when(F.col("doc_id") % 9 == 0, F.sha2(F.lit("other"), 256)).otherwise(F.upper("raw_sha256")))
    return replays.replay(changed, stored).groupBy(F.coalesce("reason", F.lit("same")).alias("reason")).agg(F.count("*").alias("n"))


@query(f"""WITH {WORDS_SQL}, {ENTRY_SQL} SELECT CASE WHEN len(makna) = 0 THEN 'parse' ELSE 'entry' END AS kind, count(*) AS n, count(DISTINCT lema) AS words FROM entry GROUP BY 1""")
def q_import(spark, sf_dir):
    """S30, 3.1, P13, P14, H18: snapshots to canonical entries; what can't be one is quarantined."""
    entries, quarantine = workflows.import_snapshots(snapshots(spark, sf_dir).select("raw_snapshot_id", "content", "url"), "official-live")
    rows = entries.select(F.lit("entry").alias("kind"), "lema").unionAll(quarantine.select(F.lit("parse").alias("kind"), "lema"))
    return rows.groupBy("kind").agg(F.count("*").alias("n"), F.count_distinct("lema").alias("words"))


@query("""WITH o AS (SELECT event_id, user_id, CASE event_type WHEN 'error' THEN 503 WHEN 'signup' THEN 404 ELSE 200 END AS status, event_id % 3 = 0 AS official, event_id % 10 = 7 AS tampered FROM events),
j AS (SELECT *, CASE WHEN status = 503 THEN 'retryable' WHEN status = 404 THEN 'failed' WHEN tampered THEN 'quarantined' ELSE 'accepted' END AS outcome FROM o)
SELECT user_id, CASE WHEN bool_or(official AND outcome = 'accepted') THEN 'accepted' WHEN bool_or(outcome = 'retryable') THEN 'retryable' ELSE 'quarantined' END AS outcome, count(*) AS attempts FROM j GROUP BY user_id""")
def q_observations(spark, sf_dir):
    """What becomes of each observation, and of each key."""
    n = F.col("event_id")
    seen = T.read(spark, sf_dir, "events").select(
        "user_id", F.when(n % 3 == 0, "official").otherwise("evidence").alias("tier"), F.when(F.col("event_type") == "error", 503).when(F.col("event_type") == "signup", 404).otherwise(200).alias("status"),
        F.encode(n.cast("string"), "UTF-8").alias("content"), F.when(n % 10 == 7, "0").otherwise(F.upper(F.sha2(n.cast("string"), 256))).alias("expected_hash"), F.lit(None).cast("string").alias("entry_failure"), F.lit(True).alias("key_matches"),
    )
    return checkpoint.key_outcomes(seen.withColumn("outcome", checkpoint.observation_outcome()), "user_id")


@query("""SELECT CASE WHEN doc_id % 4 = 0 THEN 'warn' WHEN doc_id % 3 = 0 THEN 'fail' ELSE 'pass' END AS verdict, count(*) AS n FROM documents GROUP BY 1""")
def q_manifest_check(spark, sf_dir):
    """A manifest against what is there."""
    listed = T.read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("hash"))
    have = listed.where("id % 4 <> 0").withColumn("hash", F.when(F.col("id") % 3 == 0, "other").otherwise(F.col("hash")))
    return replays.manifest_check(listed, have).groupBy("verdict").agg(F.count("*").alias("n"))


@query("""SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN lang WHEN doc_id % 3 = 0 THEN source END AS content, CASE WHEN doc_id % 2 = 0 THEN 0 WHEN doc_id % 3 = 0 THEN 1 END AS source FROM documents""")
def q_raw_cascade(spark, sf_dir):
    """Raw content from the first place that has it."""
    docs = T.read(spark, sf_dir, "documents").withColumn("raw_snapshot_id", F.col("doc_id").cast("string"))
    first, second = docs.where("doc_id % 2 = 0").select("raw_snapshot_id", F.col("lang").alias("content")), docs.where("doc_id % 3 = 0").select("raw_snapshot_id", F.col("source").alias("content"))
    return replays.raw_cascade(docs.select("doc_id", "raw_snapshot_id"), first, second).select("doc_id", "content", "source")


@query("""SELECT user_id AS run_id, arg_max(event_type, event_id) AS status, max(event_id) AS revision, CASE WHEN user_id % 2 = 0 THEN 'holder' END AS owner FROM events GROUP BY user_id ORDER BY user_id""")
def q_run_history(spark, sf_dir):
    """S22, S23, ST12, H06, H16, T11: each run's last status with its lease, in order."""
    events = T.read(spark, sf_dir, "events").select(F.col("user_id").alias("run_id"), F.col("event_type").alias("status"), F.col("event_id").alias("revision"))
    leases = events.select("run_id").distinct().where("run_id % 2 = 0").withColumn("owner", F.lit("holder"))
    return replays.latest_status(events, leases).orderBy("run_id")


@query("""WITH l AS (SELECT user_id, event_type, row_number() OVER w AS n, sum(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END) OVER w AS block FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)),
s AS (SELECT *, CASE WHEN event_type = 'error' THEN row_number() OVER (PARTITION BY user_id, block, event_type = 'error' ORDER BY n) ELSE 0 END AS streak FROM l),
e AS (SELECT user_id, coalesce(min(n) FILTER (WHERE event_type = 'purchase' OR streak = 4), max(n)) AS attempts FROM s GROUP BY user_id)
SELECT s.user_id AS user_id, CASE WHEN event_type = 'purchase' THEN 'completed' WHEN streak > 3 THEN 'failed' WHEN streak > 0 THEN 'interrupted' ELSE 'running' END AS state, attempts, streak AS errors FROM s JOIN e ON s.user_id = e.user_id AND n = attempts""")
def q_run_lifecycle(spark, sf_dir):
    """ST01, ST02, ST03, ST06, K07: the stateful operator over the events as a stream, to its end."""
    schema = T.read(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").option("recursiveFileLookup", "false").parquet(sf_dir)
    return runs.drained(runs.lifecycle(stream), "lifecycle")


@query("""SELECT doc_id, 'https://example.org/entri/' || replace(lang, ' ', '%20') || '%20' || source AS url, CASE WHEN doc_id % 2 = 0 THEN doc_id END AS number, 'gen-' || CAST(doc_id % 9 + 1 AS VARCHAR) AS generation, upper(lang[1]) || lang[2:] AS name,
  '{"value":"' || source || '"}' AS details, 'a-b-c' || lang AS file FROM documents""")
def q_text_functions(spark, sf_dir):
    """S03, F06, F10, F12, F14, F15, F46."""
    n = F.col("doc_id")
    return T.read(spark, sf_dir, "documents").select(
        "doc_id", X.url_of("https://example.org/entri/", F.concat_ws(" ", "lang", "source")).alias("url"), X.durable_int(F.when(n % 2 == 0, n.cast("string")).otherwise("true")).alias("number"),
        X.next_generation(F.concat(F.lit("gen-"), (n % 9).cast("string"))).alias("generation"), X.capitalised(F.col("lang")).alias("name"), X.details(F.col("source")).alias("details"), X.file_slug(F.concat(F.lit(" A b/C"), "lang")).alias("file"),
    )


@query("""SELECT event_id, CASE event_id % 4 WHEN 0 THEN CAST(event_id % 50 AS DOUBLE) WHEN 1 THEN 90.0 WHEN 2 THEN 0.0 END AS wait, CASE WHEN event_id % 2 = 0 THEN '[REDACTED]' ELSE 'v' END AS cookie, 'v' AS plain FROM events""")
def q_headers(spark, sf_dir):
    """How long an answer asks to wait; secrets in a map."""
    n, now = F.col("event_id"), F.lit("2024-01-01 00:00:00").cast("timestamp")
    header = F.when(n % 4 == 0, (n % 50).cast("string")).when(n % 4 == 1, "Mon, 01 Jan 2024 00:01:30 GMT").when(n % 4 == 2, "Sun, 31 Dec 2023 00:00:00 GMT").otherwise("-5")
    key = F.when(n % 2 == 0, "Set-Cookie").otherwise("name")
    masked = X.redacted(F.create_map(key, F.lit("v"), F.lit("note"), F.lit("v")))
    return T.read(spark, sf_dir, "events").select("event_id", X.retry_after(header, now).alias("wait"), masked[key].alias("cookie"), masked["note"].alias("plain"))


@query("""WITH c AS (SELECT doc_id, sha256(CAST(to_json({doc_id: doc_id, lang: lang, source: source}) AS VARCHAR)) AS h FROM documents)
SELECT 'conflict-' || h[:32] AS review_id, CAST(doc_id AS VARCHAR) AS stable_key, h AS hash FROM c""")
def q_reviews_opened(spark, sf_dir):
    """Reviews whose ids are made of their evidence."""
    rows = T.read(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return reviews.opened(rows, "doc_id", ["lang", "source"]).select("review_id", F.col("stable_key").cast("string").alias("stable_key"), "hash")


@query("""WITH d AS (SELECT user_id, arg_max(event_type, event_id) AS last, count(*) AS decisions FROM events GROUP BY user_id), r AS (SELECT c_custkey AS k, c_custkey % 3 = 0 AS conflict, last, coalesce(decisions, 0) AS decisions FROM customer LEFT JOIN d ON c_custkey = user_id),
s AS (SELECT *, CASE last WHEN 'purchase' THEN 'approved' WHEN 'error' THEN 'rejected' WHEN 'signup' THEN 'quarantined' ELSE 'pending' END AS status FROM r)
SELECT status AS review_status, CASE WHEN status IN ('pending', 'quarantined') THEN 'review_open' WHEN conflict AND status <> 'approved' THEN 'conflict_not_resolved' END AS blocks, count(*) AS n, CAST(sum(decisions) AS BIGINT) AS decisions FROM s GROUP BY ALL""")
def q_reviews_current(spark, sf_dir):
    """S21, ST09, T08, P25, H08, H16: reviews with their last decision, and whether they block a release."""
    kept = T.read(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("review_id"), F.col("c_custkey").alias("stable_key"), F.when(F.col("c_custkey") % 3 == 0, "conflict").otherwise("quarantine").alias("kind"))
    said = F.when(F.col("event_type") == "purchase", "select_official").when(F.col("event_type") == "error", "reject").when(F.col("event_type") == "signup", "quarantine").otherwise("defer")
    decisions = T.read(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("review_id"), said.alias("decision"), F.col("event_id").alias("at"))
    return reviews.current(kept, decisions).groupBy("review_status", reviews.blocking().alias("blocks")).agg(F.count("*").alias("n"), F.sum("decisions").alias("decisions"))


@query("""SELECT doc_id AS review_id FROM documents WHERE doc_id % 6 = 0""")
def q_changed_evidence(spark, sf_dir):
    """Evidence that is not what it was."""
    before = T.read(spark, sf_dir, "documents").select(F.col("doc_id").alias("review_id"), F.col("lang").alias("hash"))
    after = before.withColumn("hash", F.when(F.col("review_id") % 6 == 0, "changed").otherwise(F.col("hash")))
    return reviews.changed_evidence(before, after).select("review_id")


@query("""WITH m AS (SELECT vec_id AS id FROM embeddings WHERE vec_id % 10 <> 1), v AS (SELECT vec_id AS id FROM embeddings WHERE vec_id % 10 <> 2 UNION ALL SELECT vec_id FROM embeddings WHERE vec_id % 10 = 3)
SELECT CAST(id AS VARCHAR) AS id, problem FROM (
  SELECT id, 'missing' AS problem FROM m WHERE id NOT IN (SELECT id FROM v) UNION ALL SELECT id, 'extra' FROM v WHERE id NOT IN (SELECT id FROM m)
  UNION ALL SELECT id, 'duplicate' FROM v GROUP BY id HAVING count(*) > 1 UNION ALL SELECT id, 'hash' FROM v WHERE id % 10 = 4 UNION ALL SELECT id, 'dimensions' FROM v WHERE id % 10 = 5 UNION ALL SELECT id, 'not_finite' FROM v WHERE id % 10 = 6)""")
def q_verify_release(spark, sf_dir):
    """3.2, J30, J31, A12, A21: a manifest against vectors broken in each way."""
    rows = T.vectors(spark, sf_dir).select(F.col("vec_id").cast("string").alias("id"), (F.col("vec_id") % 10).alias("n"), "embedding", F.sha2(F.col("vec_id").cast("string"), 256).alias("hash"))
    manifest = rows.where("n <> 1").select("id", "hash")
    vectors = rows.where("n <> 2").unionAll(rows.where("n = 3")).select(
        "id", F.when(F.col("n") == 4, "other").otherwise(F.col("hash")).alias("content_hash"),
        F.when(F.col("n") == 5, F.slice("embedding", 1, 3)).when(F.col("n") == 6, F.transform("embedding", lambda x: F.lit(float("inf")))).otherwise(F.col("embedding")).alias("embedding"),
    )
    return workflows.verify_release(manifest, vectors, 64)


@query("""WITH p AS (SELECT doc_id, lang FROM documents WHERE doc_id % 10 < 8), c AS (SELECT doc_id, lang FROM documents WHERE doc_id % 10 > 1)
SELECT CASE WHEN d.doc_id % 11 = 0 THEN 'excluded' WHEN p.doc_id IS NULL THEN 'new' WHEN c.doc_id IS NULL THEN 'removed' WHEN d.doc_id % 3 = 0 THEN 'changed' ELSE 'unchanged' END AS class, count(*) AS n
FROM documents d LEFT JOIN p ON d.doc_id = p.doc_id LEFT JOIN c ON d.doc_id = c.doc_id GROUP BY 1""")
def q_delta_incompatible(spark, sf_dir):
    """Stored vectors that can't be used are made again; what is excluded gets none."""
    rows = T.read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("hash"))
    plan = releases.delta_plan(rows.where("id % 10 < 8"), rows.where("id % 10 > 1"), rows.where("id % 3 = 0"), rows.where("id % 11 = 0"))
    return plan.groupBy("class").agg(F.count("*").alias("n"))


@query("""SELECT vec_id, round(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(q.e AS DOUBLE[])), 6) + 0.0 AS similarity FROM embeddings, (SELECT embedding AS e FROM embeddings WHERE vec_id = 0) q
WHERE 1 - list_dot_product(CAST(embedding AS DOUBLE[]), CAST(q.e AS DOUBLE[])) <= 0.5 AND list_dot_product(CAST(embedding AS DOUBLE[]), CAST(q.e AS DOUBLE[])) >= 0.5""")
def q_adapted(spark, sf_dir):
    """Hits within a distance whose similarity reaches the same number."""
    from leksika.plans.lookups import one_vector

    rows = T.vectors(spark, sf_dir)
    scored = rows.withColumn("distance", R.DISTANCES["DOT_PRODUCT"](F.col("embedding"), one_vector(spark, sf_dir)))
    return R.adapted(scored, 0.5).select("vec_id", (F.round("similarity", 6) + 0.0).alias("similarity"))


@query(f"""WITH {T.ENTRIES_SQL} SELECT id, source_kind AS kind, sha256(definisi) AS content_hash, 'v' || CAST((SELECT max(c_custkey) FROM customer) AS VARCHAR) AS release_version, 'gen-' || CAST((SELECT max(c_custkey) FROM customer) AS VARCHAR) AS release_generation
FROM entries WHERE status = 'active' AND source_kind IN ('official-live', 'official-snapshot')""")
def q_citations(spark, sf_dir):
    """What may be read, cited, with the release that is current."""
    number = F.col("c_custkey").cast("string")
    releases_ = T.read(spark, sf_dir, "customer").select(F.concat(F.lit("v"), number).alias("version"), F.concat(F.lit("gen-"), number).alias("generation"))
    rows = T.entries(spark, sf_dir).where(R.active_official()).withColumn("c", R.citation())
    return replays.with_release(rows.select("id", F.col("c.sourceKind").alias("kind"), F.col("c.contentHash").alias("content_hash")), releases_)


@query(f"""WITH {T.ENTRIES_SQL} SELECT lema_lc, arg_max(id, doc_id) AS id FROM entries GROUP BY lema_lc ORDER BY lema_lc""")
def q_all_entries(spark, sf_dir):
    """Each word's last entry, in order."""
    return drivers.all_entries(T.entries(spark, sf_dir)).select("lema_lc", "id")


@query(f"""WITH {T.ENTRIES_SQL} SELECT id, lema, status FROM entries WHERE id = '17'""")
def q_point_get(spark, sf_dir):
    """The entry of one id."""
    return drivers.by_id(T.entries(spark, sf_dir), "17").select("id", "lema", "status")


@query("""SELECT doc_id, doc_id % 2 = 0 AS valid FROM documents""")
def q_run_ids(spark, sf_dir):
    """The form of run ids."""
    digest = F.sha2(F.col("doc_id").cast("string"), 256)
    name = F.concat(F.lit("checkpoint-"), F.when(F.col("doc_id") % 2 == 0, F.substring(digest, 1, 20)).otherwise(F.upper(F.lpad(digest, 12, "0"))))
    return T.read(spark, sf_dir, "documents").select("doc_id", drivers.run_id_valid(name).alias("valid"))


@query("""SELECT doc_id, array_to_string(list_filter([CASE WHEN doc_id % 2 = 0 THEN 'lema' END, CASE WHEN doc_id % 3 = 0 THEN 'makna' END, CASE WHEN doc_id % 5 = 0 THEN 'labels' END], lambda x: x IS NOT NULL), ',') AS differs FROM documents""")
def q_field_diff(spark, sf_dir):
    """The fields in which two entries differ, nulls being equal, in fixed order."""
    n, same = F.col("doc_id"), {"lema": F.col("lang"), "makna": F.array("source"), "labels": F.lit(None).cast("array<string>"), "status": F.lit(None).cast("string")}
    other = same | {"lema": F.when(n % 2 == 0, "x").otherwise(F.col("lang")), "makna": F.when(n % 3 == 0, F.array(F.lit("x"), F.lit("y"))).otherwise(F.array("source")), "labels": F.when(n % 5 == 0, F.array(F.lit("x")))}
    return T.read(spark, sf_dir, "documents").select("doc_id", F.array_join(validation.differing(same, other), ",").alias("differs"))


@query("""SELECT CASE doc_id % 6 WHEN 0 THEN 'unreadable' WHEN 1 THEN 'lema' WHEN 2 THEN 'makna' WHEN 3 THEN 'not_public' ELSE 'entry' END AS reason, count(*) AS n FROM documents GROUP BY 1""")
def q_foreign(spark, sf_dir):
    """Documents of another store, read as entries; what is none is left out with its reason."""
    n = F.col("doc_id") % 6
    kind, word, senses = F.when(n == 3, "fallback").otherwise("official-live"), F.when(n == 1, " ").otherwise(F.col("lang")), F.when(n == 2, "[]").otherwise('[{"definisi": "x"}]')
    text = F.format_string('{"id": "%d", "lema": "%s", "makna": %s, "status": "active", "source": {"source_kind": "%s"}}', "doc_id", word, senses, kind)
    rows = T.read(spark, sf_dir, "documents").select(F.when(n == 0, F.concat(F.lit("{"), "lang")).otherwise(text).alias("json"))
    good, bad = T.foreign_entries(rows)
    return good.select(F.lit("entry").alias("reason")).unionAll(bad.select("reason")).groupBy("reason").agg(F.count("*").alias("n"))


@query("""SELECT doc_id, strftime(TIMESTAMP '2024-05-01' + to_days(CAST(doc_id % 300 AS INTEGER)), '%Y-%m-%d') || '.1' AS tag, doc_id % 2 = 0 AS valid, sha256('{"lang":"' || lang || '","source":null}' || chr(10)) AS bytes FROM documents""")
def q_hash_forms(spark, sf_dir):
    """Release tags, the form of hashes, canonical bytes."""
    n, digest = F.col("doc_id"), F.sha2("lang", 256)
    at = F.timestamp_seconds(F.lit(1714521600) + (n % 300) * 86400)
    fields = {"source": F.lit(None).cast("string"), "lang": F.col("lang")}
    return T.read(spark, sf_dir, "documents").select("doc_id", X.release_tag(at).alias("tag"), H.hash_valid(F.when(n % 2 == 0, digest).otherwise(F.concat(F.lit("A"), F.substring(digest, 2, 63)))).alias("valid"), F.sha2(H.canonical_bytes(fields), 256).alias("bytes"))
