"""Streams: incremental runs with resumable commits, run lifecycle, and windows over events."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from leksika.session import shared_dir
from leksika.sources.artifacts import write_text
from leksika.sources.sinks import path_of

LIFECYCLE = "user_id long, state string, attempts long, errors long"


def incremental(source: DataFrame, commit: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> StreamingQuery:
    """ST02, ST03, ST11: run ``commit`` on each micro-batch; a restart with the same checkpoint resumes after the last one committed."""
    return source.writeStream.outputMode(mode).foreachBatch(commit).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def append_once(path: str) -> Callable[[DataFrame, int], None]:
    """A commit that writes a batch under its number, so that a batch that runs twice is written once."""

    def commit(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return commit


class Blocked(ValueError):
    """A run that may not go on: its input or rules have changed, or had before."""


def run_fingerprint(**pins: object) -> str:
    """The hash of what a run's results rest on: its input, rules and versions."""
    return hashlib.sha256(json.dumps(pins, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def progressed(batch: DataFrame, number: int) -> DataFrame:
    """A batch with the run's cursor (batches committed with it) and revision (2 for the first, one more for each)."""
    return batch.withColumns({"cursor": F.lit(number + 1).cast("long"), "revision": F.lit(number + 2).cast("long")})


def status_of(spark: SparkSession, root: str) -> dict | None:
    """A run's fingerprint and status, null before it is created. The newest of its records, which are only ever added."""
    folder, fs = path_of(spark, f"{root}/status")
    names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
    if not names:
        return None
    return json.loads(spark.read.text(f"{root}/status/{max(names)}", wholetext=True).first()[0])


def _note(spark: SparkSession, root: str, number: int, fingerprint: str, status: str) -> dict:
    record = {"number": number, "fingerprint": fingerprint, "status": status}
    write_text(spark, f"{root}/status/{number:09d}.json", json.dumps(record))  # fails if another driver noted this number
    return record


def resume(source: DataFrame, commit: Callable[[DataFrame, int], None], root: str, fingerprint: str, limit: int | None = None) -> str:
    """ST03, T14: run a stream to its end, or go on with a run that was interrupted; the status it ends in.

    The fingerprint of the first call is kept beside the offsets in ``root``. A call with the same one goes on behind the
    last batch committed, and does nothing to a run that is completed. A call with another one commits nothing: it
    blocks an unfinished run for good and leaves a completed one as it is; both raise ``Blocked``. ``limit`` interrupts after
    so many batches; a batch that fails interrupts too and raises its error.
    """
    spark = source.sparkSession
    have = status_of(spark, root)
    if have and have["status"] == "blocked":
        raise Blocked("the run is blocked; a new run needs a new folder")
    if have and have["fingerprint"] != fingerprint:
        if have["status"] != "completed":
            _note(spark, root, have["number"] + 1, have["fingerprint"], "blocked")
        raise Blocked("input or rules differ from those of the run")
    if have and have["status"] == "completed":
        return "completed"
    have = _note(spark, root, have["number"] + 1 if have else 0, fingerprint, "running")
    done, full = 0, False

    def counted(batch: DataFrame, number: int) -> None:
        nonlocal done, full
        if done == limit:
            full = True
            raise Blocked("limit")  # before anything is committed, so this batch is the first of the next call
        commit(batch, number)
        done += 1

    status = "interrupted"
    try:
        incremental(source, counted, f"{root}/offsets").awaitTermination()
        status = "completed"
    except StreamingQueryException:
        if not full:
            raise
    finally:
        _note(spark, root, have["number"] + 1, fingerprint, status)
    return status


def tumbling(events: DataFrame, size: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts and sums for each window and kind of event; works on a stream and on a table."""
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    return rows.groupBy(F.window("ts", size).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sliding(events: DataFrame, size: str = "2 hours", step: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    return rows.groupBy(F.window("ts", size, step).alias("w")).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "n")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    return rows.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("start"), "n")


def without_repeats(events: DataFrame, key: str = "event_id", late: str = "10 minutes") -> DataFrame:
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark([key]) if events.isStreaming else events.dropDuplicates([key])


def lifecycle(events: DataFrame, max_retries: int = 3) -> DataFrame:
    """ST01, ST06 on a stream: each user's run: created, running, interrupted after errors, failed when retries are exhausted, completed by a purchase.

    A user's events of one micro-batch may come in several Arrow batches, cut anywhere, so they are put in order together: 17 bytes an event are held.
    """

    def slim(pdf: pd.DataFrame) -> pd.DataFrame:
        kind = (pdf["event_type"] == "purchase").astype("int8") + 2 * (pdf["event_type"] == "error").astype("int8")
        return pdf[["ts", "event_id"]].assign(kind=kind)

    def step(key: tuple, batches, state: GroupState):
        run, attempts, errors = state.get if state.exists else ("created", 0, 0)
        for kind in pd.concat(map(slim, batches)).sort_values(["ts", "event_id"])["kind"]:
            if run in ("completed", "failed"):
                break
            attempts += 1
            errors = errors + 1 if kind == 2 else 0
            run = "completed" if kind == 1 else "failed" if errors > max_retries else "interrupted" if errors else "running"
        state.update((run, attempts, errors))
        yield pd.DataFrame([(key[0], run, attempts, errors)], columns=["user_id", "state", "attempts", "errors"])

    return events.groupBy("user_id").applyInPandasWithState(step, LIFECYCLE, "state string, attempts long, errors long", "update", GroupStateTimeout.NoTimeout)


def drained(stream: DataFrame, name: str) -> DataFrame:
    """The rows of a stream that is read to its end: each batch is written under its number, so one that runs twice is written once.

    Rows and offsets are in the shared folder.
    """
    spark = stream.sparkSession
    root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    incremental(stream, append_once(f"{root}/rows"), f"{root}/offsets", "update").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/rows").select(*stream.columns)


def event_stream(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """A stream of the Parquet files of a folder, one file a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
