"""Runs that are interrupted, drift, complete or fail."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from leksika.streaming import runs

SCHEMA = "id long"


@pytest.fixture
def stream(spark, tmp_path):
    for i in range(5):
        spark.range(i * 10, i * 10 + 10).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return runs.event_stream(spark, str(tmp_path / "in"), SCHEMA)


def sink(path):
    return lambda batch, number: runs.append_once(path)(runs.progressed(batch, number), number)


def ids(spark, path):
    return sorted(r.id for r in spark.read.parquet(path).collect())


def test_interrupted_run_resumes_behind_its_last_batch(spark, stream, tmp_path):
    root, out = str(tmp_path / "run"), str(tmp_path / "out")
    mark = runs.run_fingerprint(input="a", rules="1")
    assert runs.resume(stream, sink(out), root, mark, limit=2) == "interrupted"
    assert len(ids(spark, out)) == 20
    assert runs.resume(stream, sink(out), root, mark, limit=2) == "interrupted"
    assert runs.resume(stream, sink(out), root, mark) == "completed"
    assert ids(spark, out) == list(range(50))
    steps = spark.read.parquet(out).groupBy("cursor").agg(F.min("revision").alias("r"), F.max("revision").alias("s"), F.count("*").alias("n")).orderBy("cursor").collect()
    assert [tuple(r) for r in steps] == [(i, i + 1, i + 1, 10) for i in range(1, 6)]


def test_drift_blocks_an_unfinished_run(spark, stream, tmp_path):
    root, out = str(tmp_path / "run"), str(tmp_path / "out")
    mark, other = runs.run_fingerprint(input="a", rules="1"), runs.run_fingerprint(input="a", rules="2")
    assert mark != other and mark == runs.run_fingerprint(rules="1", input="a")
    runs.resume(stream, sink(out), root, mark, limit=1)
    before = ids(spark, out)
    for fingerprint in (other, mark):  # a blocked run stays blocked
        with pytest.raises(runs.Blocked):
            runs.resume(stream, sink(out), root, fingerprint)
    assert ids(spark, out) == before
    assert runs.status_of(spark, root)["status"] == "blocked" and runs.status_of(spark, root)["fingerprint"] == mark


def test_completed_run_is_a_no_op_and_refuses_drift(spark, stream, tmp_path):
    root, out = str(tmp_path / "run"), str(tmp_path / "out")
    mark = runs.run_fingerprint(input="a")
    assert runs.resume(stream, sink(out), root, mark) == "completed"
    number = runs.status_of(spark, root)["number"]

    def never(batch, at):
        raise AssertionError("a completed run commits nothing")

    assert runs.resume(stream, never, root, mark) == "completed"
    with pytest.raises(runs.Blocked):
        runs.resume(stream, never, root, runs.run_fingerprint(input="b"))
    assert runs.status_of(spark, root) == {"number": number, "fingerprint": mark, "status": "completed"}


def test_failed_batch_interrupts_and_is_done_again(spark, stream, tmp_path):
    root, out = str(tmp_path / "run"), str(tmp_path / "out")

    def failing(batch, number):
        if number == 3:
            raise RuntimeError("lost")
        sink(out)(batch, number)

    with pytest.raises(StreamingQueryException):
        runs.resume(stream, failing, root, "f")
    assert runs.status_of(spark, root)["status"] == "interrupted"
    assert runs.resume(stream, sink(out), root, "f") == "completed"
    assert ids(spark, out) == list(range(50))


def test_run_over_nothing(spark, tmp_path):
    (tmp_path / "in").mkdir()
    empty = runs.event_stream(spark, str(tmp_path / "in"), SCHEMA)
    assert runs.status_of(spark, str(tmp_path / "run")) is None
    assert runs.resume(empty, sink(str(tmp_path / "out")), str(tmp_path / "run"), "f") == "completed"
