"""Checkpointed ingest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leksika.functions.text import backoff, status_class
from leksika.operators.ordered import sequenced, tree_digest
from leksika.operators.validation import first_failure

# Classes of outcomes.
OUTCOMES = ("accepted", "conflict", "quarantined", "retryable", "failed", "excluded", "pending")
TERMINAL = ("accepted", "conflict", "quarantined", "failed", "excluded")


def selection(catalog: DataFrame, key: str = "stable_key", limit: int = 100) -> DataFrame:
    """The first keys in order, with their index; a bounded top-k, so the ranking is one small task."""
    if isinstance(limit, bool) or not 1 <= int(limit) <= 100:
        raise ValueError("limit must be a whole number from 1 to 100")
    first = catalog.select(key).distinct().orderBy(key).limit(int(limit))
    return first.withColumn("selected_index", F.row_number().over(Window.orderBy(key)) - 1)


def ordered_bindings(bindings: DataFrame, key: str, tier: Column, *then: str) -> DataFrame:
    """A key's bindings, officials first, with index from 0 and sequence from 1; a key of any size is many tasks' work."""
    placed = sequenced(bindings.withColumn("__tier", tier), key, "__tier", *then).drop("__tier")
    return placed.withColumn("binding_index", F.col("sequence") - 1).select(*bindings.columns, "binding_index", "sequence")


def first_accepted(bindings: DataFrame, key: str, accepted: Column) -> DataFrame:
    """Each key's first accepted official binding, by partial aggregation."""
    kept = bindings.where(accepted)
    return kept.groupBy(key).agg(F.min_by(F.struct(*[c for c in bindings.columns if c != key]), "sequence").alias("b")).select(key, "b.*")


def attempts(transport: DataFrame, key: str, order: list[str], status: str, max_retries: int = 3) -> DataFrame:
    """Each attempt's number, cumulative count, class, wait and whether retries are exhausted; a key of any size is many tasks' work."""
    placed = sequenced(transport, key, *order)
    numbered = placed.withColumn("attempt", F.col("sequence") - 1).withColumn("kind", status_class(F.col(status)))
    return (
        numbered.withColumn("cumulative", F.col("sequence").cast("long")).drop("sequence")
        .withColumn("wait", F.when(F.col("kind") == "transient", backoff(F.col("attempt"))))
        .withColumn("exhausted", (F.col("kind") == "transient") & (F.col("attempt") >= max_retries))
    )


#: Physical rows in one list of a logical attempt.
LIST = 1000


def logical_attempts(physical: DataFrame, key: str, order: list[str], attempt_id: str, outcome: str, conflict: str, size: int = LIST) -> tuple[DataFrame, DataFrame]:
    """One logical attempt for each key, and the physical rows that it owns, in order.

    The first is key, attempt_count, first_attempt, last_attempt, outcome (accepted if a row is, else conflict, retryable or
    that of the last row), conflict_id, parts. The second is key, part, source_attempts: lists of up to ``size`` rows with their
    sequence, so a key with a million rows is a thousand lists in as many tasks. The conflict's id, the smallest that
    a row of the key names, stands on the logical row and on each row in conflict.
    """
    placed = sequenced(physical, key, *order)
    at = lambda c: F.struct(F.col("sequence"), F.col(c))
    has = lambda value: F.bool_or(F.coalesce(F.col(outcome) == value, F.lit(False)))
    logical = placed.groupBy(key).agg(
        F.count("*").alias("attempt_count"), F.min(at(attempt_id))[attempt_id].alias("first_attempt"), F.max(at(attempt_id))[attempt_id].alias("last_attempt"),
        F.when(has("accepted"), "accepted").when(has("conflict"), "conflict").when(has("retryable"), "retryable").otherwise(F.max(at(outcome))[outcome]).alias("outcome"),
        F.min(conflict).alias("conflict_id"), F.ceil(F.count("*") / size).cast("int").alias("parts"),
    )
    named = placed.join(logical.select(F.col(key).alias("__key"), F.col("conflict_id").alias("__conflict")), F.col(key).eqNullSafe(F.col("__key"))).drop("__key")
    rows = named.withColumn(conflict, F.when(F.col(outcome) == "conflict", F.col("__conflict")).otherwise(F.col(conflict))).drop("__conflict")
    fields = F.struct("sequence", *[c for c in rows.columns if c not in (key, "sequence")])
    nested = rows.withColumn("part", F.floor((F.col("sequence") - 1) / size).cast("int")).groupBy(key, "part").agg(F.array_sort(F.collect_list(fields)).alias("source_attempts"))
    return logical, nested


def observation_outcome() -> Column:
    """What becomes of an observation; its columns status, content, expected_hash, entry_failure, key_matches."""
    return F.coalesce(
        first_failure(
            (status_class(F.col("status")) == "transient", "retryable"), (F.col("status") >= 400, "failed"), (F.col("content").isNull(), "failed"),
            (F.lower("expected_hash") != F.sha2("content", 256), "quarantined"), (F.col("entry_failure").isNotNull(), "quarantined"), (~F.col("key_matches"), "quarantined"),
        ),
        F.lit("accepted"),
    )


def key_outcomes(observations: DataFrame, key: str) -> DataFrame:
    """A key's outcome from its observations: accepted if an official one is, else retryable if any is, else quarantined."""
    accepted = (F.col("tier") == "official") & (F.col("outcome") == "accepted")
    return observations.groupBy(key).agg(
        F.when(F.bool_or(accepted), "accepted").when(F.bool_or(F.col("outcome") == "retryable"), "retryable").otherwise("quarantined").alias("outcome"),
        F.count("*").alias("attempts"),
    )


def outcome_counts(outcomes: DataFrame, column: str = "outcome") -> DataFrame:
    """Rows of every class, zeros included."""
    classes = outcomes.sparkSession.createDataFrame([(o,) for o in OUTCOMES], "outcome string")
    counts = outcomes.groupBy(F.col(column).alias("outcome")).agg(F.count("*").alias("n"))
    return F.broadcast(classes).join(counts, "outcome", "left").select("outcome", F.coalesce("n", F.lit(0)).alias("n"))


def completion(outcomes: DataFrame, column: str = "outcome") -> DataFrame:
    """Terminal and pending rows, completion, eligibility and the reasons against it."""
    terminal, blocked = F.col(column).isin(*TERMINAL), F.col(column) == "retryable"
    counted = outcomes.agg(F.count_if(terminal).alias("terminal"), F.count_if(~terminal).alias("pending"), F.coalesce(F.bool_and(terminal), F.lit(True)).alias("complete"), F.coalesce(F.bool_or(blocked), F.lit(False)).alias("blocked"))
    return counted.withColumn("eligible", F.col("complete") & ~F.col("blocked")).withColumn("reasons", F.filter(F.array(F.when(~F.col("complete"), "incomplete"), F.when(F.col("blocked"), "retryable")), lambda x: x.isNotNull()))


def conservation(selected: DataFrame, outcomes: DataFrame, key: str) -> DataFrame:
    """A05, U-S7, U-S8: whether every selected key has one outcome and no other key has."""
    extra = outcomes.select(key).distinct().join(selected, key, "left_anti").agg(F.count("*").alias("extra"))
    lost = selected.select(key).distinct().join(outcomes, key, "left_anti").agg(F.count("*").alias("missing"))
    sizes = outcomes.agg(F.count("*").alias("rows"), F.count_distinct(key).alias("keys"))
    conserved = (F.col("extra") == 0) & (F.col("missing") == 0) & (F.col("rows") == F.col("keys"))
    return sizes.join(F.broadcast(extra)).join(F.broadcast(lost)).withColumn("conserved", conserved)


def fingerprint(records: DataFrame, key: str, record: Column) -> DataFrame:
    """N, fingerprint: one hash over records by key, whatever order they came in; a tree of hashes in order of key."""
    return tree_digest(records, key, record)


def with_reviews(outcomes: DataFrame, reviews: DataFrame, key: str, review: str) -> DataFrame:
    """Outcomes with their key's reviews, sorted, and whether one still blocks."""
    grouped = reviews.groupBy(key).agg(F.array_sort(F.collect_list(review)).alias("reviews"))
    return outcomes.join(grouped, key, "left").withColumn("reviews", F.coalesce("reviews", F.array().cast("array<string>"))).withColumn("blocked", F.array_contains("reviews", "open"))


def exactly_one(outcomes: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Each outcome with how many rows of ``other`` have its key, and whether that is one."""
    counts = other.groupBy(key).agg(F.count("*").alias("matches"))
    return outcomes.join(counts, key, "left").withColumn("matches", F.coalesce("matches", F.lit(0))).withColumn("exactly_one", F.col("matches") == 1)


def lineage(outcomes: DataFrame, attempts: DataFrame, observations: DataFrame, raws: DataFrame, artifacts: DataFrame, keys: list[str]) -> DataFrame:
    """Each outcome's first broken link, or null: attempt, observation, raw bytes, artifact.

    ``attempts`` (attempt_id, ``keys``), ``observations`` (observation_id, raw_snapshot_id), ``raws`` (raw_snapshot_id,
    content, raw_sha256) and ``artifacts`` (``keys``, artifact_hash) are joined once each.
    """
    tried = attempts.groupBy("attempt_id").agg(F.count("*").alias("__tries"), *[F.first(k).alias(f"__a_{k}") for k in keys])
    seen = observations.select("observation_id", F.col("raw_snapshot_id").alias("__raw"))
    bytes_ = raws.select(F.col("raw_snapshot_id").alias("__raw"), (F.sha2("content", 256) == F.col("raw_sha256")).alias("__intact"))
    made = artifacts.select(*keys, F.col("artifact_hash").alias("__artifact"))
    met = outcomes.join(tried, "attempt_id", "left").join(seen, "observation_id", "left").join(bytes_, "__raw", "left").join(made, keys, "left")
    other = F.lit(False)
    for k in keys:
        other = other | ~F.col(k).eqNullSafe(F.col(f"__a_{k}"))
    reason = first_failure(
        (F.col("__tries").isNull(), "attempt_missing"), (F.col("__tries") > 1, "attempt_ambiguous"), (other, "attempt_mismatch"),
        (F.col("__raw").isNull(), "observation_missing"), (F.col("__intact").isNull(), "raw_missing"), (~F.col("__intact"), "raw_hash_mismatch"),
        (F.col("__artifact").isNull(), "artifact_missing"), (~F.col("__artifact").eqNullSafe(F.col("canonical_hash")), "artifact_hash_mismatch"),
    )
    return met.select(*outcomes.columns, reason.alias("reason"))
