"""Releases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leksika.functions.hashing import pseudo_vector
from leksika.operators.checkpoint import fingerprint
from leksika.operators.ordered import ranked

CHUNK = 500


def delta_plan(prior: DataFrame, candidate: DataFrame, incompatible: DataFrame | None = None, excluded: DataFrame | None = None) -> DataFrame:
    """Id, class (new, changed, unchanged, removed, excluded), old_hash, new_hash; one full outer join.

    ``prior`` and ``candidate`` have id, hash. An id of ``incompatible`` (its stored vector can't be used) is
    changed even with an equal hash; an id of ``excluded`` gets no work.
    """
    p, c = prior.select("id", F.col("hash").alias("old_hash"), F.lit(True).alias("was")), candidate.select("id", F.col("hash").alias("new_hash"), F.lit(True).alias("is"))
    both = p.join(c, "id", "full_outer")
    redo = F.lit(False)
    if incompatible is not None:
        both = both.join(incompatible.select("id", F.lit(True).alias("redo")).distinct(), "id", "left")
        redo = F.coalesce("redo", F.lit(False))
    out = F.lit(False)
    if excluded is not None:
        both = both.join(excluded.select("id", F.lit(True).alias("out")).distinct(), "id", "full_outer")
        out = F.coalesce("out", F.lit(False))
    same = F.col("old_hash").eqNullSafe(F.col("new_hash")) & ~redo
    kind = F.when(out, "excluded").when(F.col("was").isNull(), "new").when(F.col("is").isNull(), "removed").when(same, "unchanged").otherwise("changed")
    return both.select("id", kind.alias("class"), "old_hash", "new_hash")


def work(plan: DataFrame, candidate: DataFrame) -> DataFrame:
    """J11, U-S4: candidate rows of new and changed ids."""
    return candidate.join(plan.where(F.col("class").isin("new", "changed")).select("id"), "id", "left_semi")


def built_vectors(plan: DataFrame, candidate: DataFrame, prior_vectors: DataFrame, dimensions: int = 768) -> DataFrame:
    """Vectors of a release: new ones computed, unchanged ones reused where they are stored; removed and excluded ids get none."""
    live = candidate.join(plan.where(F.col("class").isin("new", "changed", "unchanged")).select("id", "class"), "id")
    met = live.join(prior_vectors.select("id", F.col("embedding").alias("stored")), "id", "left")
    reuse = (F.col("class") == "unchanged") & F.col("stored").isNotNull()
    return met.select("id", "class", reuse.alias("reused"), F.when(reuse, F.col("stored")).otherwise(pseudo_vector(F.col("document"), dimensions)).alias("embedding"))


def class_counts(plan: DataFrame) -> DataFrame:
    """Rows in each class and provider calls, and whether classes partition both sides."""
    n = lambda *k: F.count_if(F.col("class").isin(*k))
    return plan.agg(
        *[n(k).alias(k) for k in ("new", "changed", "unchanged", "removed", "excluded")],
        n("new", "changed").alias("provider_calls"), (F.count("*") == F.count_distinct("id")).alias("conserved"),
    )


def chunks(rows: DataFrame, order: str, size: int = CHUNK, ranges: int | None = None) -> DataFrame:
    """Rows with their chunk, ``floor(rank / size)``, ranked by ranges without one task for all."""
    return ranked(rows, order, ranges=ranges).withColumn("chunk", F.floor(F.col("rank") / size)).drop("rank")


def preflight(batch: DataFrame, existing: DataFrame, key: str = "id", digest: str = "hash") -> DataFrame:
    """What a create-only write would do with each row: write, no-op or conflict.

    Rows of one key that disagree are conflicts; repeated ones are one row, whole as it came, chosen by partial aggregation.
    A row without a hash is one that agrees with others without.
    """
    whole = F.min_by(F.struct(*batch.columns), F.struct(F.col(digest).isNull(), F.col(digest)))
    once = batch.groupBy(key).agg(whole.alias("__row"), F.max(digest).alias("__most"), (F.count(digest) < F.count("*")).alias("__lacks")).select("__row.*", "__most", "__lacks")
    have = existing.groupBy(key).agg(F.min(digest).alias("__have"), F.max(digest).alias("__has"), F.lit(True).alias("__is"))
    apart = ~F.col(digest).eqNullSafe(F.col("__most")) | (F.col("__lacks") & F.col(digest).isNotNull())
    same = F.col("__have").eqNullSafe(F.col(digest)) & F.col("__has").eqNullSafe(F.col(digest))
    action = F.when(apart, "conflict").when(F.col("__is").isNull(), "write").when(same, "no-op").otherwise("conflict")
    return once.join(have, key, "left").withColumn("action", action).select(*batch.columns, "action")


def batch_ledger(judged: DataFrame, key: str = "id", size: int = CHUNK, fail_chunk: int | None = None) -> tuple[DataFrame, DataFrame]:
    """K05, A15, ST07: the rows of a judged batch with their chunk and whether it commits, and the ledger: chunk, size, first, last, status.

    A batch with a conflict commits nothing; a chunk that fails (``fail_chunk`` makes one fail) and all after it stay open.
    """
    conflicts = judged.where("action = 'conflict'").limit(1).count() > 0
    numbered = chunks(judged, key, size)
    status = F.lit("refused") if conflicts else F.lit("committed") if fail_chunk is None else F.when(F.col("chunk") < fail_chunk, "committed").when(F.col("chunk") == fail_chunk, "failed").otherwise("open")
    rows = numbered.withColumn("status", status)
    ledger = rows.groupBy("chunk", "status").agg(F.count("*").alias("size"), F.count_if(F.col("action") == "write").alias("written"), F.min(key).alias("first"), F.max(key).alias("last"))
    return rows, ledger.select("chunk", "size", "written", "first", "last", "status")


def batch_result(ledger: DataFrame) -> DataFrame:
    """Records, chunks committed and failed, status (complete, partial, conflict) and whether the batch may be released."""
    n = lambda *k: F.count_if(F.col("status").isin(*k))
    counted = ledger.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("records"), F.count("*").alias("chunks"), n("committed").alias("committed_chunks"), n("failed", "refused", "open").alias("open_chunks"), n("refused").alias("refused"))
    status = F.when(F.col("refused") > 0, "conflict").when(F.col("open_chunks") > 0, "partial").otherwise("complete")
    return counted.withColumn("status", status).withColumn("eligible", F.col("status") == "complete").drop("refused")


def deduplicated(rows: DataFrame, key: str, digest: str) -> DataFrame:
    """Each key once, with whether its rows disagree."""
    return rows.groupBy(key).agg(F.min(digest).alias(digest), F.count("*").alias("copies"), (F.count_distinct(digest) > 1).alias("conflict"))


def manifest(entries: DataFrame, key: str, digest: str, status: str) -> DataFrame:
    """Counts, and the fingerprint of ids with their hashes."""
    counts = entries.agg(F.count("*").alias("entries"), F.count_if(F.col(status) == "active").alias("active"), F.count_if(F.col(status) == "inactive").alias("inactive"))
    return counts.join(F.broadcast(fingerprint(entries, key, F.concat_ws(":", key, digest)).select(F.col("fingerprint").alias("digest"))))


def missing_and_extra(expected: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """J30, U-S6: keys expected and not there, and there and not expected."""
    lost = expected.select(key).distinct().join(actual, key, "left_anti").withColumn("problem", F.lit("missing"))
    more = actual.select(key).distinct().join(expected, key, "left_anti").withColumn("problem", F.lit("extra"))
    return lost.unionAll(more)


def repeated(rows: DataFrame, key: str) -> DataFrame:
    """Keys that stand more than once."""
    return rows.groupBy(key).agg(F.count("*").alias("copies")).where("copies > 1")


def pointer_chain(events: DataFrame, scope: list[str], order: str, source: str, target: str) -> DataFrame:
    """W11, ST10: each event with what the pointer was before it and whether the event says so."""
    window = Window.partitionBy(*scope).orderBy(order)
    return events.withColumn("previous", F.lag(target).over(window)).withColumn("generation", F.row_number().over(window)).withColumn("chained", F.col(source).eqNullSafe(F.col("previous")))


def current_pointer(events: DataFrame, scope: list[str], order: str, target: str) -> DataFrame:
    """Where each pointer stands."""
    return events.groupBy(*scope).agg(F.max_by(target, order).alias("version"), F.count("*").alias("generation"))


def map_digest(pairs: Column) -> Column:
    """hash over the sorted entries of a map."""
    return F.sha2(F.array_join(F.transform(F.array_sort(F.map_entries(pairs)), lambda e: F.concat_ws(":", e["key"], e["value"])), "\n"), 256)
