"""Queries that publish projections."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from leksika.operators import projections as P
from leksika.plans.lookups import OFFICIAL
from leksika.plans.registry import Registry
from leksika.session import new_path
from leksika.sources import artifacts as A
from leksika.sources import tables as T
from leksika.sources.sinks import remove

query = Registry()


@query(f"""WITH {T.ENTRIES_SQL}, {T.PUBLISHED_SQL} SELECT id, lema, id AS source_entry_id, canonical_content_hash, raw_content_hash, source_url, source_kind, 'r1' AS source_release,
  array_to_string(list_sort(kelas_kata), '|') AS kelas_kata, bentuk_baku, array_to_string(list_sort(bentuk_tidak_baku), '|') AS bentuk_tidak_baku FROM hashed WHERE {OFFICIAL}""")
def q_word_projection(spark, sf_dir):
    """P10, P02, P03, T06, F34."""
    found = P.words(T.published(spark, sf_dir), "r1")
    return found.withColumns({c: F.array_join(c, "|") for c in ("kelas_kata", "bentuk_tidak_baku")})


EDGES = f"""edges AS (
  SELECT v AS "from", lema AS "to", id, 0 AS rank, 'bentuk_tidak_baku' AS canonical_field, canonical_content_hash AS source_hash FROM hashed, unnest(list_distinct(bentuk_tidak_baku)) AS u(v) WHERE {OFFICIAL} AND trim(v) <> ''
  UNION ALL SELECT lema, bentuk_baku, id, 1, 'bentuk_baku', canonical_content_hash FROM hashed WHERE {OFFICIAL} AND trim(bentuk_baku) <> '')"""


@query(f"""WITH {T.ENTRIES_SQL}, {T.PUBLISHED_SQL}, {EDGES}
SELECT "from", "to", 'nonstandard_variant' AS type, id AS source_entry_id, canonical_field, source_hash, 'r1' AS source_release FROM edges QUALIFY row_number() OVER (PARTITION BY "from", "to" ORDER BY id, rank) = 1""")
def q_relations_projection(spark, sf_dir):
    """A19, T07, P02."""
    return P.relations(T.published(spark, sf_dir), "r1")


@query("""SELECT d.doc_id AS doc_id, CASE WHEN l.doc_id IS NULL AND d.doc_id % 2 = 0 THEN 'unavailable' WHEN l.doc_id IS NULL OR d.doc_id % 2 = 0 THEN 'pending' WHEN l.quality = 1 THEN 'validated' ELSE 'failed' END AS status
FROM documents d LEFT JOIN labels l USING (doc_id)""")
def q_projection_status(spark, sf_dir):
    """P26, S25."""
    labels = T.read(spark, sf_dir, "labels").select("doc_id", "quality")
    rows = T.read(spark, sf_dir, "documents").select("doc_id").join(labels, "doc_id", "left")
    return rows.select("doc_id", P.status(F.col("quality").isNotNull(), F.col("doc_id") % 2 == 1, F.coalesce(F.col("quality") == 1, F.lit(False))).alias("status"))


@query(f"""WITH {T.ENTRIES_SQL}, x AS (SELECT v AS f, lema AS t, CAST(doc_id AS INTEGER) % 4 AS n FROM entries, unnest(variants) AS u(v))
SELECT array_to_string(list_filter([CASE WHEN trim(f) = '' THEN 'from' END, CASE WHEN trim(t) = '' THEN 'to' END, CASE WHEN n = 1 THEN 'type' END, CASE WHEN n = 2 THEN 'canonical_field' END, CASE WHEN n = 3 THEN 'source_hash' END, CASE WHEN n = 3 THEN 'release' END], lambda e: e IS NOT NULL), ',') AS failures, count(*) AS n FROM x GROUP BY 1""")
def q_relation_checks(spark, sf_dir):
    """Records with a wrong field each."""
    n = F.col("doc_id") % 4
    rows = T.entries(spark, sf_dir).select(
        F.explode("variants").alias("from"), F.col("lema").alias("to"), F.when(n == 1, "other").otherwise(P.RELATION).alias("type"), F.col("id").alias("source_entry_id"),
        F.when(n == 2, "lema").otherwise("bentuk_baku").alias("canonical_field"), F.when(n == 3, "short").otherwise(F.sha2("definisi", 256)).alias("source_hash"), F.when(n == 3, "r0").otherwise("r1").alias("source_release"),
    )
    return rows.groupBy(F.array_join(P.relation_failures("r1"), ",").alias("failures")).agg(F.count("*").alias("n"))


@query(f"""WITH {T.ENTRIES_SQL}, {T.PUBLISHED_SQL} SELECT array_to_string(list_filter([CASE WHEN trim(lema) = '' THEN 'lema' END, CASE WHEN id LIKE '%7' THEN 'raw_content_hash' END, CASE WHEN id LIKE '%3' THEN 'source_entry' END], lambda e: e IS NOT NULL), ',') AS failures, count(*) AS n FROM hashed WHERE {OFFICIAL} GROUP BY 1""")
def q_word_checks(spark, sf_dir):
    """Word records with a wrong hash or another entry's id."""
    rows = P.words(T.published(spark, sf_dir), "r1")
    rows = rows.withColumn("raw_content_hash", F.when(F.col("id").endswith("7"), "ABC").otherwise(F.col("raw_content_hash"))).withColumn("source_entry_id", F.when(F.col("id").endswith("3"), "other").otherwise(F.col("source_entry_id")))
    return rows.groupBy(F.array_join(P.word_failures("r1"), ",").alias("failures")).agg(F.count("*").alias("n"))


@query(f"""WITH {T.ENTRIES_SQL}, {T.PUBLISHED_SQL} SELECT id AS source_entry_id, canonical_content_hash, raw_content_hash FROM hashed WHERE {OFFICIAL} ORDER BY 1""")
def q_source_entries(spark, sf_dir):
    """A manifest's entries, in order of id."""
    return P.source_entries(P.of_track(T.published(spark, sf_dir), "r1", "word"))


#: What happens to the artifact of each release of ``q_projection_list``.
TAMPERED = ("sound", "manifest_hash_mismatch", "output_hash_mismatch", "artifact_missing", "manifest_missing")


@query(f"""WITH {T.ENTRIES_SQL}, {T.PUBLISHED_SQL}, r AS (SELECT unnest(range({len(TAMPERED)})) AS n)
SELECT 'r' || CAST(r.n AS VARCHAR) AS release, [{", ".join(f"'{t}'" for t in TAMPERED)}][r.n + 1] AS reason, CASE WHEN r.n < 4 THEN count(h.id) END AS output_count
FROM r LEFT JOIN hashed h ON h.source_kind IN ('official-live', 'official-snapshot') AND h.status = 'active' AND CAST(h.id AS BIGINT) % 7 <> r.n GROUP BY r.n""")
def q_projection_list(spark, sf_dir):
    """Releases published with their manifests, and what a listing says after some were tampered with."""
    root = new_path(spark, "projections")
    entries = T.published(spark, sf_dir)
    for n, what in enumerate(TAMPERED):
        rows = entries.where(F.col("id").cast("long") % 7 != n)
        identity = A.Identity("web", "word", f"r{n}", "gen-1", A.SCHEMAS["word"])
        A.publish_artifact(P.words(rows, f"r{n}"), root, identity, ["id"], n, "0" * 64)
        path = identity.path(root)
        if what == "manifest_hash_mismatch":
            text = json.dumps(A.manifest_of(spark, root, identity) | {"source_count": 9}, sort_keys=True, separators=(",", ":"))
            remove(spark, f"{path}/manifest.json")
            A.write_text(spark, f"{path}/manifest.json", text)
        elif what == "output_hash_mismatch":
            P.words(rows, f"r{n}").limit(1).write.mode("append").parquet(f"{path}/data")
        elif what == "artifact_missing":
            remove(spark, f"{path}/data")
        elif what == "manifest_missing":
            remove(spark, f"{path}/manifest.json")
    return A.artifacts(spark, root).select(F.regexp_extract("folder", "/(r[0-9]+)/", 1).alias("release"), F.coalesce("reason", F.lit("sound")).alias("reason"), "output_count")
