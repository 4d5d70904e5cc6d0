"""Validation, quarantine and conflicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leksika.operators.retrieval import OFFICIAL

# Authority layers by source kind, and closed domains.
LAYERS = {
    "official-live": "kbbi_official_live", "official-snapshot": "kbbi_official_snapshot", "rule": "badan_bahasa_rule", "sipebi": "sipebi_public",
    "gov-derived": "gov_derived_snapshot", "fallback": "mirror_fallback", "enrichment": "enrichment", "evaluation": "evaluation", "ai-proposal": "ai_proposal",
}
STATUSES = ("active", "inactive", "unresolved")
REVIEW_STATUSES = ("pending", "approved", "rejected", "quarantined")
LEXICAL_FIELDS = ("lema", "sub_lema", "ejaan", "kelas_kata", "makna", "contoh", "turunan", "bentuk_baku", "bentuk_tidak_baku", "pelafalan", "pemenggalan", "etimologi", "labels", "status")
PARSER = "0.1.0"
# What a vector record names.
MODEL, TASK, DISTANCE, SCHEMA = "gemini-embedding-001", "RETRIEVAL_DOCUMENT", "DOT_PRODUCT", "emb-768-v1"


def layer(kind: Column) -> Column:
    """the authority layer of a source kind, null if unknown."""
    return F.element_at(F.create_map(*[F.lit(x) for pair in LAYERS.items() for x in pair]), kind)


def canonical_writer(kind: Column) -> Column:
    """P15."""
    return kind.isin(*OFFICIAL)


def first_failure(*checks: tuple[Column, str | Column]) -> Column:
    """The reason of the first check that holds; a check that is null doesn't. Null if none holds."""
    reason = F.lit(None).cast("string")
    for failed, name in reversed(checks):
        reason = F.when(failed, name).otherwise(reason)
    return reason


def entry_failure(raw_hash: Column | None = None, kind: str = "source_kind", makna: str = "makna", status: str = "status", review: str = "review_status", digest: str = "content_hash", parser: str = "parser_version", source_parser: str = "source_parser_version") -> Column:
    """Why an entry may not enter the canonical corpus, in the order in which it is checked; null if it may."""
    k = F.col(kind)
    checks = [
        (layer(k).isNull(), "unknown_source_kind"),
        (~canonical_writer(k), "authority_violation"),
        (F.col(makna).isNull() | (F.size(makna) <= 0), "empty_makna"),
        (~F.coalesce(F.col(status).isin(*STATUSES), F.lit(False)), "invalid_status"),
        (~F.coalesce(F.col(review).isin(*REVIEW_STATUSES), F.lit(False)), "invalid_review_status"),
        (~F.coalesce(F.col(digest).rlike("^[0-9a-f]{64}$"), F.lit(False)), "invalid_content_hash"),
    ]
    if raw_hash is not None:
        checks.append((raw_hash != F.col(digest), "hash_mismatch"))
    checks.append((~(F.col(parser).eqNullSafe(PARSER) & F.col(source_parser).eqNullSafe(PARSER)), "parser_version_mismatch"))
    return first_failure(*checks)


def split_valid(entries: DataFrame, failure: Column) -> tuple[DataFrame, DataFrame]:
    """Entries that pass, and the quarantine of the others with their reasons."""
    judged = entries.withColumn("reason", failure)
    return judged.where("reason is null").drop("reason"), judged.where("reason is not null")


def violations(*checks: tuple[Column, str]) -> Column:
    """The names of all checks that hold, in order."""
    return F.filter(F.array(*[F.when(failed, name) for failed, name in checks]), lambda x: x.isNotNull())


def vector_violations(dimensions: int = 768, release: str | None = None, columns: tuple[str, ...] = ()) -> Column:
    """What is wrong with a vector record, in order; of fields beyond embedding and content_hash those that are among ``columns`` are checked.

    Null is no violation for task, distance_measure and schema_version, which older records lack.
    """
    has = lambda name: name in columns
    fixed = lambda name, value: (~F.coalesce(F.col(name) == value, F.lit(False)), name)
    tolerant = lambda name, value: (F.coalesce(F.col(name) != value, F.lit(False)), name)
    checks = [
        (~F.coalesce(F.size("embedding") == dimensions, F.lit(False)), "dimensions"),
        (~F.coalesce(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False)), "not_finite"),
        (~F.coalesce(F.col("content_hash").rlike("^[0-9a-f]{64}$"), F.lit(False)), "content_hash"),
    ]
    checks += [] if release is None else [(~F.col("version").eqNullSafe(release), "version")]
    checks += [fixed("model", MODEL)] if has("model") else []
    checks += [(fixed("dimensions", dimensions)[0], "stated_dimensions")] if has("dimensions") else []
    checks += [(F.coalesce(F.col(c), F.lit("")) == "", c) for c in ("canonical_content_hash", "source_kind") if has(c)]
    checks += [tolerant(c, v) for c, v in (("task", TASK), ("distance_measure", DISTANCE), ("schema_version", SCHEMA)) if has(c)]
    return violations(*checks)


def differing(left: dict[str, Column], right: dict[str, Column]) -> Column:
    """Names of fields whose values differ, nulls being equal, in the order given."""
    return violations(*[(~left[f].eqNullSafe(right[f]), f) for f in left])


def official_and_evidence(observations: DataFrame, key: str, tier: str, fields: list[str], order: str) -> DataFrame:
    """Each key's first official row against its first differing evidence row, with the fields that differ."""
    ranked = observations.withColumn("n", F.row_number().over(Window.partitionBy(key, tier).orderBy(order)))
    official = ranked.where((F.col(tier) == "official") & (F.col("n") == 1)).select(key, *[F.col(f).alias(f"official_{f}") for f in fields])
    evidence = observations.where(F.col(tier) != "official").select(key, order, *[F.col(f).alias(f"evidence_{f}") for f in fields])
    met = evidence.join(official, key).withColumn("differs", differing({f: F.col(f"official_{f}") for f in fields}, {f: F.col(f"evidence_{f}") for f in fields}))
    conflicts = met.where(F.size("differs") > 0)
    return conflicts.groupBy(key).agg(F.min_by(F.struct(*[c for c in conflicts.columns if c != key]), order).alias("c")).select(key, "c.*")


def review_state(decisions: DataFrame, review: str, order: str, decision: str) -> DataFrame:
    """ST09: each review's latest decision and how many it had; decisions are only ever added."""
    return decisions.groupBy(review).agg(F.max_by(decision, order).alias("decision"), F.count("*").alias("decisions"))


def decision_conflicts(decisions: DataFrame, key: str, payload: str) -> DataFrame:
    """ST09: idempotency keys that were used with different payloads."""
    return decisions.groupBy(key).agg(F.count_distinct(payload).alias("payloads")).where("payloads > 1")
