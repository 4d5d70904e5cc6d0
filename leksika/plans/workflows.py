"""Whole workflows: import, release, verification, publication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leksika.functions.hashing import canonical_json, lexical_hash, sha256
from leksika.operators import checkpoint, ordered, parsing, projections, releases, validation
from leksika.session import written
from leksika.sources import artifacts, catalogs, tables


def import_snapshots(snapshots: DataFrame, source_kind: str) -> tuple[DataFrame, DataFrame]:
    """S30, 3.1: raw snapshots (raw_snapshot_id, content, url) to canonical entries and a quarantine with reasons."""
    parsed = parsing.parse(snapshots).join(snapshots.select("raw_snapshot_id", sha256(F.col("content")).alias("content_hash")), "raw_snapshot_id")
    rows = parsed.select(
        "*", F.lit(source_kind).alias("source_kind"), F.lit("active").alias("status"), F.lit("pending").alias("review_status"),
        F.lit("0.1.0").alias("parser_version"), F.lit("0.1.0").alias("source_parser_version"),
    )
    failure = F.coalesce(F.when(F.col("error").isNotNull(), F.concat(F.lit("parse: "), F.col("error"))), validation.entry_failure())
    return validation.split_valid(written(rows.withColumn("reason", failure), "imported"), F.col("reason"))


def run_catalog(spark: SparkSession, path: str, limit: int = 100, official: tuple[str, ...] = catalogs.OFFICIAL_HOSTS) -> dict[str, DataFrame]:
    """3.1: a catalog's selection, observations, outcomes and report; inline fixtures only, as files are joined by their reader."""
    found = catalogs.records(catalogs.entries(spark, path), official)
    valid = found.where("reason is null")
    selected = checkpoint.selection(valid, "stable_key", limit)
    bound = catalogs.bindings(valid.join(selected.select("stable_key"), "stable_key", "left_semi"))
    official = validation.canonical_writer(F.col("source.source_kind"))
    ordered = checkpoint.ordered_bindings(bound, "stable_key", F.when(official, 0).otherwise(1), "place")
    seen = ordered.select(
        "stable_key", "binding_index", "sequence", F.when(official, "official").otherwise("evidence").alias("tier"), F.concat_ws("#", "stable_key", "binding_index").alias("raw_snapshot_id"),
        F.coalesce(F.col("transport.status").cast("int"), F.lit(200)).alias("status"), tables.transport_bytes(F.col("transport")).alias("content"),
        F.col("transport.expected_raw_hash").alias("expected_hash"), F.col("source.url").alias("url"), F.col("source.source_kind").alias("source_kind"),
    )
    parsed = parsing.parse(seen.where("content is not null").select("raw_snapshot_id", "content", "url")).drop("url")
    met = seen.join(parsed, "raw_snapshot_id", "left").withColumn("entry_failure", F.when(F.col("content").isNotNull(), F.col("error"))).withColumn("key_matches", F.coalesce(F.lower("lema") == F.col("stable_key"), F.lit(True)))
    observations = met.withColumn("outcome", checkpoint.observation_outcome())
    outcomes = checkpoint.key_outcomes(observations, "stable_key")
    return {"rejected": found.where("reason is not null"), "selected": selected, "observations": observations, "outcomes": outcomes, "report": checkpoint.completion(outcomes), "conservation": checkpoint.conservation(selected, outcomes, "stable_key")}


def with_document(entries: DataFrame) -> DataFrame:
    """Entries with lexical hash and embedding document."""
    fields = {c: F.col(c) for c in entries.columns}
    return entries.select("*", lexical_hash(fields).alias("hash"), projections.embedding_document(fields).alias("document"))


def build_release(prior: DataFrame, candidate: DataFrame, prior_vectors: DataFrame, dimensions: int = 768) -> tuple[DataFrame, DataFrame]:
    """S31, 3.2: the delta plan and the vectors of the candidate release; only new and changed entries are embedded."""
    plan = releases.delta_plan(prior, candidate)
    return plan, releases.built_vectors(plan, candidate, prior_vectors, dimensions)


def verify_release(manifest: DataFrame, vectors: DataFrame, dimensions: int = 768) -> DataFrame:
    """3.2, J30-J32: id, problem for every disagreement of a manifest (id, hash) and vectors (id, content_hash, embedding); none if they agree."""
    listed = releases.missing_and_extra(manifest, vectors, "id").select("id", "problem")
    twice = releases.repeated(vectors, "id").select("id", F.lit("duplicate").alias("problem"))
    met = vectors.join(manifest.select("id", F.col("hash").alias("__hash")), "id")
    checks = validation.violations(
        (F.size("embedding") != dimensions, "dimensions"), (F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), "not_finite"), (~F.col("content_hash").eqNullSafe(F.col("__hash")), "hash"),
    )
    return listed.unionAll(twice).unionAll(met.select("id", F.explode(checks).alias("problem")))


def publish_tracks(entries: DataFrame, root: str, consumer: str, release: str, generation: str) -> dict[str, bool]:
    """3.2, K08, K09: the word and relation tracks of a release, each published once with its manifest."""
    made = {"word": (projections.words(entries, release), ["id"]), "relations": (projections.relations(entries, release), ["from", "to", "type", "source_entry_id"])}
    source = projections.eligible(entries, release)
    source_count, source_digest = ordered.tree_digest(source, "id", projections.canonical_hash(entries)).first()
    return {
        track: artifacts.publish_artifact(rows, root, artifacts.Identity(consumer, track, release, generation, artifacts.SCHEMAS[track]), order, source_count, source_digest)
        for track, (rows, order) in made.items()
    }


def record_json(entries: DataFrame) -> DataFrame:
    """A canonical JSON line of each entry, keys sorted, nulls kept."""
    return entries.select("id", canonical_json({c: F.col(c) for c in entries.columns}).alias("json"))
