"""Sinks: create-only, staged and partitioned writes."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leksika.operators.releases import CHUNK, batch_ledger, batch_result, preflight


class Conflict(ValueError):
    """Rows to be created are there already, with other content."""


def path_of(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = path_of(spark, path)
    return fs.exists(p)


def judged_batch(rows: DataFrame, path: str, key: str, digest: str) -> DataFrame:
    """The rows with what a create-only write would do with them, against the table at ``path`` if there is one."""
    spark = rows.sparkSession
    existing = spark.read.parquet(path) if exists(spark, path) else rows.where("false")
    return preflight(rows, existing, key, digest)


def create_only(rows: DataFrame, path: str, key: str = "id", digest: str = "hash") -> int:
    """Append rows whose keys are new; the same content again is a no-op, other content, in the table or in the batch, an error. Rows written.

    What is judged is written first, so what is counted is what is appended whatever is lost on the way; a lock keeps
    other writers out between the judgement and the append.
    """
    spark, staging = rows.sparkSession, f"{path}.judged-{uuid.uuid4().hex}"
    with locked(spark, path):
        try:
            judged_batch(rows, path, key, digest).write.parquet(staging)
            judged = spark.read.parquet(staging)
            counts = dict(judged.groupBy("action").count().collect())
            if counts.get("conflict"):
                raise Conflict(f"{counts['conflict']} keys have other content")
            judged.where("action = 'write'").drop("action").write.mode("append").parquet(path)
            return counts.get("write", 0)
        finally:
            remove(spark, staging)


def persist_batch(rows: DataFrame, path: str, ledger_path: str, batch_id: str, key: str = "id", digest: str = "hash", size: int = CHUNK, fail_chunk: int | None = None) -> dict:
    """Create-only and in chunks: the rows of committed chunks are appended, and the ledger of the batch is written beside them.

    A conflict writes no row. A chunk that fails leaves it and the ones after it out; the same batch again writes
    just these, since what is there is a no-op. What was judged is written first, beside the table, so that what is
    appended, counted and noted is the same whatever is lost on the way. Returns ``batch_result`` as a dict.
    """
    spark, staging = rows.sparkSession, f"{path}.{batch_id}.judged"
    judged_batch(rows, path, key, digest).write.mode("overwrite").parquet(staging)
    try:
        numbered, ledger = batch_ledger(spark.read.parquet(staging), key, size, fail_chunk)
        result = batch_result(ledger).first().asDict()
        numbered.where("status = 'committed' and action = 'write'").select(*rows.columns).write.mode("append").parquet(path)
        ledger.withColumn("batch_id", F.lit(batch_id)).write.mode("append").parquet(ledger_path)
        return result
    finally:
        remove(spark, staging)


def archive(snapshots: DataFrame, path: str) -> None:
    """Raw bytes by kind and date."""
    dated = snapshots.withColumn("retrieved_date", F.to_date("retrieved_at"))
    dated.write.mode("append").partitionBy("source_kind", "retrieved_date").parquet(path)


def quarantine(rows: DataFrame, path: str) -> None:
    """Append to the quarantine: rows with their reasons and when they came."""
    rows.withColumn("quarantined_at", F.current_timestamp()).write.mode("append").parquet(path)


def quarantined(spark: SparkSession, path: str, reason: str | None = None) -> DataFrame | None:
    """The quarantine, or what is there for a reason; None if nothing ever was."""
    if not exists(spark, path):
        return None
    rows = spark.read.parquet(path)
    return rows if reason is None else rows.where(F.col("reason") == reason)


def digest_of(rows: DataFrame) -> tuple:
    """Rows, and two sums of hashes over them in any order: equal for tables that hold the same rows."""
    columns = sorted(rows.columns)
    return tuple(rows.agg(F.count("*"), F.sum(F.xxhash64(*columns).cast("decimal(38,0)")), F.sum(F.hash(*columns).cast("long"))).first())


#: Seconds after which a lock counts as left by a writer that is dead.
LOCK_S = 3600


@contextmanager
def locked(spark: SparkSession, path: str, seconds: float = LOCK_S) -> Iterator[None]:
    """A lock file beside ``path`` that one writer can create; one that is older than ``seconds`` is taken over, and only the own one is removed."""
    lock, fs = path_of(spark, f"{path}.lock")
    fs.mkdirs(lock.getParent())
    if fs.exists(lock) and time.time() - fs.getFileStatus(lock).getModificationTime() / 1000 > seconds:
        fs.delete(lock, False)
    if not fs.createNewFile(lock):
        raise Conflict(f"another writer publishes {path}")
    made = fs.getFileStatus(lock).getModificationTime()
    try:
        yield
    finally:
        if fs.exists(lock) and fs.getFileStatus(lock).getModificationTime() == made:
            fs.delete(lock, False)


def take(spark: SparkSession, staging: str, path: str) -> None:
    """Rename a staged folder to ``path``, which must not be there: the one step that decides between writers."""
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(path_of(spark, path)[0].toUri(), spark._jsc.hadoopConfiguration())
    none = spark._jvm.org.apache.hadoop.fs.Options.Rename.NONE
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = none
    qualified = lambda p: path_of(spark, p)[1].makeQualified(path_of(spark, p)[0])
    try:
        context.rename(qualified(staging), qualified(path), options)
    except Py4JJavaError as failed:
        raise Conflict(f"{path} could not be taken: {failed.java_exception.getMessage()}") from None


def publish(rows: DataFrame, path: str, order: list[str], fault: Callable[[str], None] = lambda step: None) -> bool:
    """Write sorted to a staging path, verify what was written, rename, verify again; False, and nothing done, if these rows are published already.

    Other rows under a published path are a conflict: the first publication stays. A lock keeps others out until one is
    done or has failed; whether there is something is asked again under it, and the rename takes the path only if nothing
    is there, so two writers leave one whole artifact. Nothing is deleted that this call did not make.
    ``fault`` is called before each step (ST07): what it raises fails the publication there.
    """
    spark = rows.sparkSession

    def published() -> bool:
        if not exists(spark, path):
            return False
        if digest_of(spark.read.schema(rows.schema).parquet(path)) != digest_of(rows):
            raise Conflict(f"{path} is published with other content")
        return True

    if published():
        return False
    staging = f"{path}.staging-{uuid.uuid4().hex}"
    with locked(spark, path):
        try:
            if published():
                return False
            fault("stage")
            rows.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(staging)
            expected = digest_of(spark.read.schema(rows.schema).parquet(staging))
            fault("verify")
            if expected != digest_of(rows):
                raise ValueError("what was staged is not what was given")
            fault("rename")
            take(spark, staging, path)
            try:
                fault("verify again")
                if digest_of(spark.read.schema(rows.schema).parquet(path)) != expected:
                    raise ValueError("what was published is not what was staged")
            except Exception:
                remove(spark, path)  # made by this call
                raise
            return True
        finally:
            remove(spark, staging)


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a table."""
    target, fs = path_of(spark, path)
    return fs.delete(target, True)


def cleanup(spark: SparkSession, path: str) -> bool:
    """Remove what failed publications of a path left, where no writer is at work."""
    lock, fs = path_of(spark, f"{path}.lock")
    if fs.exists(lock):
        return False
    left = fs.globStatus(path_of(spark, f"{path}.staging-*")[0]) or []
    return any([fs.delete(s.getPath(), True) for s in left])
