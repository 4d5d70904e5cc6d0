"""Review records: deterministic ids, immutable evidence, decisions that are only added."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leksika.functions.hashing import canonical_json, sha256
from leksika.operators.validation import first_failure

# Decisions and the review status that each leads to.
DECISIONS = {"select_official": "approved", "reject": "rejected", "quarantine": "quarantined", "defer": "pending"}
OPEN = ("pending", "quarantined")


def review_id(kind: str, evidence: dict[str, Column]) -> Column:
    """``kind-`` and half a hash of the evidence: the same evidence is the same review."""
    return F.concat(F.lit(f"{kind}-"), F.substring(sha256(canonical_json(evidence)), 1, 32))


def opened(conflicts: DataFrame, key: str, evidence: list[str], kind: str = "conflict") -> DataFrame:
    """A pending review for each row, its evidence as JSON and hash, to be written create-only."""
    columns = {c: F.col(c) for c in (key, *evidence)}
    return conflicts.select(review_id(kind, columns).alias("review_id"), F.lit(kind).alias("kind"), F.col(key).alias("stable_key"), canonical_json(columns).alias("evidence"), sha256(canonical_json(columns)).alias("hash")).dropDuplicates(["review_id"])


def decision_failure(reviews: str = "kind", decision: str = "decision") -> Column:
    """ST09: why a decision can't be taken; only a conflict has an official side to select."""
    blank = lambda c: F.col(c).isNull() | (F.trim(c) == "")
    return first_failure(
        (~F.coalesce(F.col(decision).isin(*DECISIONS), F.lit(False)), "decision"), (blank("reviewer"), "reviewer"), (blank("reason"), "reason"), (blank("policy_version"), "policy_version"),
        ((F.col(decision) == "select_official") & (F.col(reviews) != "conflict"), "no_official_side"),
    )


def current(reviews: DataFrame, decisions: DataFrame, order: str = "at") -> DataFrame:
    """S21, ST09: reviews with their latest decision, status and number of decisions."""
    last = decisions.groupBy("review_id").agg(F.max_by("decision", order).alias("decision"), F.count("*").alias("decisions"))
    status = F.lit("pending")
    for decision, leads_to in DECISIONS.items():
        status = F.when(F.col("decision") == decision, leads_to).otherwise(status)
    return reviews.join(last, "review_id", "left").withColumn("decisions", F.coalesce("decisions", F.lit(0))).withColumn("review_status", status)


def queue(reviews: DataFrame) -> DataFrame:
    """Open reviews, in order of key and id."""
    return reviews.where(F.col("review_status").isin(*OPEN)).orderBy("stable_key", "review_id")


def blocking(kind: str = "kind", status: str = "review_status") -> Column:
    """P25: why a review blocks a release; null if it doesn't."""
    return first_failure((F.col(status).isin(*OPEN), "review_open"), ((F.col(kind) == "conflict") & (F.col(status) != "approved"), "conflict_not_resolved"))


def changed_evidence(before: DataFrame, after: DataFrame) -> DataFrame:
    """Reviews whose evidence is not what it was."""
    old = before.select("review_id", F.col("hash").alias("__old"))
    return after.join(old, "review_id").where(~F.col("hash").eqNullSafe(F.col("__old"))).drop("__old")
