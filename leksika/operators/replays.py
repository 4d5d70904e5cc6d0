"""Replays and ledger reads: read-only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leksika.functions.hashing import sha256
from leksika.operators.parsing import parse
from leksika.operators.validation import first_failure

FIELDS = ("id", "lema", "kelas_kata", "makna", "contoh", "bentuk_tidak_baku")


def replay(snapshots: DataFrame, stored: DataFrame) -> DataFrame:
    """raw_snapshot_id and what a second parse disagrees about, or null.

    ``snapshots`` have raw_snapshot_id, content, url, raw_sha256; ``stored`` raw_snapshot_id and the fields of an entry.
    """
    again = parse(snapshots).select("raw_snapshot_id", F.col("error").alias("__error"), F.struct(*FIELDS).alias("__again"))
    kept = stored.select("raw_snapshot_id", F.struct(*FIELDS).alias("__kept"))
    met = snapshots.join(again, "raw_snapshot_id").join(kept, "raw_snapshot_id", "left")
    reason = first_failure(
        (sha256(F.col("content")) != F.lower("raw_sha256"), "raw_hash_mismatch"), (F.col("__error").isNotNull(), "parse_failed"),
        (F.col("__kept").isNull(), "not_stored"), (~F.col("__again").eqNullSafe(F.col("__kept")), "entry_mismatch"),
    )
    return met.select("raw_snapshot_id", reason.alias("reason"))


def manifest_check(manifest: DataFrame, canonical: DataFrame) -> DataFrame:
    """Each listed id: pass, warn (no local entry), fail (another hash)."""
    have = canonical.select("id", F.col("hash").alias("__have"), F.lit(True).alias("__is"))
    verdict = F.when(F.col("__is").isNull(), "warn").when(F.col("hash").eqNullSafe(F.col("__have")), "pass").otherwise("fail")
    return manifest.join(have, "id", "left").select("id", verdict.alias("verdict"))


def latest_status(statuses: DataFrame, leases: DataFrame | None = None) -> DataFrame:
    """S22, S23, ST12, H06: each run's last status by revision, with its lease if there is one."""
    last = statuses.groupBy("run_id").agg(F.max_by(F.struct(*[c for c in statuses.columns if c != "run_id"]), "revision").alias("s")).select("run_id", "s.*")
    return last if leases is None else last.join(leases, "run_id", "left")


def history(statuses: DataFrame) -> DataFrame:
    """The runs, in order of id."""
    return latest_status(statuses).orderBy("run_id")


def raw_cascade(wanted: DataFrame, *sources: DataFrame) -> DataFrame:
    """Content of each raw_snapshot_id from the first source (raw_snapshot_id, content) that has it."""
    ranked = None
    for rank, source in enumerate(sources):
        rows = source.select("raw_snapshot_id", "content", F.lit(rank).alias("rank"))
        ranked = rows if ranked is None else ranked.unionByName(rows)
    best = ranked.groupBy("raw_snapshot_id").agg(F.min_by("content", "rank").alias("content"), F.min("rank").alias("source"))
    return wanted.join(best, "raw_snapshot_id", "left")


def with_release(rows: DataFrame, current: DataFrame) -> DataFrame:
    """Rows with the active release: that of the highest generation number, one row, broadcast; nulls if none is active."""
    number = F.regexp_extract(F.col("generation").cast("string"), r"(\d+)$", 1).try_cast("long")
    active = current.agg(F.max_by(F.struct("version", "generation"), F.struct(number, "version")).alias("r")).select(F.col("r.version").alias("release_version"), F.col("r.generation").alias("release_generation"))
    return rows.join(F.broadcast(active), F.lit(True), "left")
