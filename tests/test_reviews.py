import json
import logging

import pytest
from pyspark.sql import functions as F

from leksika import logs
from leksika.operators import replays, reviews
from leksika.sources import sinks


def test_reviews(spark, tmp_path):
    conflicts = spark.createDataFrame([("k1", "a", "b"), ("k1", "a", "b"), ("k2", "a", None)], "stable_key string, official string, evidence_text string")
    found = reviews.opened(conflicts, "stable_key", ["official", "evidence_text"])
    again = reviews.opened(conflicts.orderBy(F.desc("stable_key")), "stable_key", ["official", "evidence_text"])
    assert sorted(found.collect()) == sorted(again.collect()) and found.count() == 2
    path = str(tmp_path / "reviews")
    assert sinks.create_only(found, path, "review_id") == 2 and sinks.create_only(again, path, "review_id") == 0
    ids = {r.stable_key: r.review_id for r in found.collect()}
    decisions = spark.createDataFrame([(ids["k1"], "defer", 1), (ids["k1"], "select_official", 2)], "review_id string, decision string, at int")
    now = reviews.current(found, decisions)
    assert {r.stable_key: (r.review_status, r.decisions) for r in now.collect()} == {"k1": ("approved", 2), "k2": ("pending", 0)}
    assert [r.stable_key for r in reviews.queue(now).collect()] == ["k2"]
    assert {r.stable_key: r.b for r in now.withColumn("b", reviews.blocking()).collect()} == {"k1": None, "k2": "review_open"}
    assert reviews.changed_evidence(found, found.withColumn("hash", F.lit("x"))).count() == 2


@pytest.mark.parametrize(("row", "reason"), [(("conflict", "select_official", "r", "x", "p"), None), (("quarantine", "select_official", "r", "x", "p"), "no_official_side"), (("conflict", "odd", "r", "x", "p"), "decision"), (("conflict", "reject", " ", "x", "p"), "reviewer"), (("conflict", "reject", "r", None, "p"), "reason")])
def test_decisions(spark, row, reason):
    df = spark.createDataFrame([row], "kind string, decision string, reviewer string, reason string, policy_version string")
    assert df.select(reviews.decision_failure()).first()[0] == reason


def test_replay_and_ledgers(spark):
    html = b"<h1>Kata</h1><p>definisi yang cukup panjang</p>"
    raw = spark.createDataFrame([(i, html, "https://k/kata") for i in ("a", "b", "c", "d")], "raw_snapshot_id string, content binary, url string")
    raw = raw.withColumn("raw_sha256", F.when(F.col("raw_snapshot_id") == "d", "0").otherwise(F.sha2("content", 256)))
    from leksika.operators.parsing import parse

    stored = parse(raw).where("raw_snapshot_id <> 'c'").withColumn("lema", F.when(F.col("raw_snapshot_id") == "b", "Lain").otherwise(F.col("lema")))
    assert {r.raw_snapshot_id: r.reason for r in replays.replay(raw, stored).collect()} == {"a": None, "b": "entry_mismatch", "c": "not_stored", "d": "raw_hash_mismatch"}
    side = lambda *rows: spark.createDataFrame(list(rows), "id string, hash string")
    assert {r.id: r.verdict for r in replays.manifest_check(side(("a", "1"), ("b", "1"), ("c", "1")), side(("a", "1"), ("b", "2"))).collect()} == {"a": "pass", "b": "fail", "c": "warn"}
    statuses = spark.createDataFrame([("r2", 1, "running"), ("r1", 2, "completed"), ("r1", 1, "running")], "run_id string, revision int, state string")
    assert [(r.run_id, r.state) for r in replays.history(statuses).collect()] == [("r1", "completed"), ("r2", "running")]
    have = replays.raw_cascade(raw.select("raw_snapshot_id"), raw.where("raw_snapshot_id = 'a'"), raw.where("raw_snapshot_id <> 'd'"))
    assert {r.raw_snapshot_id: r.source for r in have.collect()} == {"a": 0, "b": 1, "c": 1, "d": None}
    none = spark.createDataFrame([], "version string, generation string")
    assert replays.with_release(raw, none).count() == 4
    assert replays.with_release(raw, spark.createDataFrame([("v", "gen-1")], none.schema)).first().release_version == "v"


def test_logs(capsys):
    logger = logs.configure()
    with logs.context(run_id="r1"):
        logger.info("done", extra={"fields": {"api_key": "x", "nested": [{"password": "y", "n": 1}]}})
    line = json.loads(capsys.readouterr().err)
    assert line == {"level": "INFO", "logger": "leksika", "message": "done", "run_id": "r1", "api_key": logs.MASK, "nested": [{"password": logs.MASK, "n": 1}]}
    assert logging.getLogger("leksika").level == logging.INFO
