"""The lifecycle of runs whose events come in several Arrow batches."""

import random

import pytest

from leksika.streaming import runs


@pytest.fixture
def small_batches(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "7")
    yield
    spark.conf.set(name, before)


def test_events_of_a_user_in_several_batches(spark, tmp_path, small_batches):
    # each user: 20 views, then four errors in a row, then a purchase, written in no order
    rows = [(n * 100 + i, i, n, "error" if 20 <= i < 24 else "purchase" if i == 24 else "view") for n in range(3) for i in range(25)]
    random.Random(5).shuffle(rows)
    events = spark.createDataFrame(rows, "event_id long, at long, user_id long, event_type string").selectExpr("event_id", "timestamp_seconds(at) AS ts", "user_id", "event_type")
    events.coalesce(1).write.parquet(f"file://{tmp_path}/in")
    stream = spark.readStream.schema(events.schema).parquet(f"file://{tmp_path}/in")
    found = {tuple(r) for r in runs.drained(runs.lifecycle(stream), "lifecycle").select("user_id", "state", "attempts", "errors").collect()}
    assert found == {(n, "failed", 24, 4) for n in range(3)}
