import pytest
from pyspark.sql import functions as F

from leksika.functions import embedding as E
from leksika.functions import text as X
from leksika.logs import masked
from leksika.operators import drivers as D
from leksika.operators.pointers import Refused
from leksika.sources import sinks, web
from leksika.streaming import runs

RUN = "checkpoint-" + "0a" * 10


def test_barriers_hold_then_fail():
    waited = []
    barrier = D.Barriers.of_request({"fault": "before-write", "barrier_hold": 2.5})
    barrier.sleep = waited.append
    barrier("combined-transaction")
    with pytest.raises(D.Injected):
        barrier("before-write")
    assert waited == [2.5]
    for bad in ({"barrier": "nowhere"}, {"barrier": "before-write", "barrier_hold": -1}):
        with pytest.raises(Refused):
            D.Barriers.of_request(bad)


def test_a_run_that_fails_at_any_phase_is_completed_by_a_restart(spark, tmp_path):
    source, schema = str(tmp_path / "in"), "id long"
    spark.range(20).coalesce(1).write.parquet(source)
    for phase in D.PHASES:
        out, at, cursor = str(tmp_path / phase / "out"), str(tmp_path / phase / "cp"), []
        stream = lambda: runs.event_stream(spark, source, schema)
        with pytest.raises(Exception, match=phase):
            runs.incremental(stream(), D.guarded(runs.append_once(out), cursor.append, D.Barriers(phase)), at).awaitTermination()
        assert cursor == ([0] if phase == "combined-transaction" else [])
        runs.incremental(stream(), D.guarded(runs.append_once(out), cursor.append, D.Barriers()), at).awaitTermination()
        assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(20)) and cursor[-1] == 0


@pytest.mark.parametrize("logged", [False, True])
def test_driver_executes_once(spark, tmp_path, logged):
    store = D.LoggedRuns(spark, str(tmp_path)) if logged else D.MemoryRuns()
    driver, steps = D.Driver(RUN, store), []
    with pytest.raises(Refused):
        driver.result()
    with pytest.raises(D.Injected):
        driver.execute(lambda: {"n": 0}, D.Barriers("durable-write-before-ack"))
    assert driver.result()["status"] == "running"
    done = driver.execute(lambda: steps.append(1) or {"n": 1})
    assert done["executed"] and done["status"] == "completed" and done["report"] == {"n": 1}
    assert not driver.execute(lambda: steps.append(2) or {})["executed"] and steps == [1]
    with pytest.raises(Refused):
        D.Driver("run-1", store)
    make = lambda root: D.MemoryRuns()
    assert D.driver_for(RUN, str(tmp_path), make) is D.driver_for(RUN, str(tmp_path), make) is not D.driver_for(RUN, "other", make)


def test_keys_references_and_leases():
    assert D.idempotency_key("  a key ") == "a key"
    for bad in ("", "  ", "x" * 257, "a\x00b", "a\x9fb", 7, None):
        with pytest.raises(Refused):
            D.idempotency_key(bad)
    assert D.references(RUN)["report"] == f"runs/{RUN}/report.json"
    assert D.lease_diagnostics(None, 5.0)["reclaimable"] and D.lease_diagnostics({"owner": "a", "expiry": 4.0}, 5.0)["reclaimable"]
    assert not D.lease_diagnostics({"owner": "a", "expiry": 6.0}, 5.0)["reclaimable"]


def test_reviews_are_read_and_decided(spark, tmp_path):
    reviews = spark.createDataFrame([("r1", "conflict", "k2"), ("r2", "quarantine", "k1")], "review_id string, kind string, stable_key string")
    decision = lambda *rows: spark.createDataFrame(list(rows), "review_id string, decision string, reviewer string, reason string, policy_version string, idempotency_key string, hash string, at long")
    path = str(tmp_path / "decisions")
    good = decision(("r1", "select_official", "a", "b", "p", "i1", "h1", 1))
    assert D.Driver.review_decide(reviews, good, path) == 1 and D.Driver.review_decide(reviews, good, path) == 0
    for bad in (decision(("r2", "select_official", "a", "b", "p", "i2", "h", 1)), decision(("r9", "reject", "a", "b", "p", "i3", "h", 1)), decision(("r1", "reject", " ", "b", "p", "i4", "h", 1))):
        with pytest.raises(Refused):
            D.Driver.review_decide(reviews, bad, path)
    decisions = spark.read.parquet(path)
    assert [r.review_id for r in D.Driver.review_queue(reviews, decisions).collect()] == ["r2"]
    assert D.Driver.review_read(reviews, decisions, "r1")["review_status"] == "approved"
    with pytest.raises(Refused):
        D.Driver.review_read(reviews, decisions, "r9")
    evaluations = spark.createDataFrame([("v1", "b", 1), ("v1", "a", 0), ("v2", "c", 0)], "release string, stable_key string, selected_index int")
    assert [r.stable_key for r in D.Driver.candidate(evaluations, "v1").collect()] == ["a", "b"]


def test_vector_table_and_legacy_lookups(spark, tmp_path):
    store = D.VectorTable(spark, str(tmp_path / "vectors"))
    rows = spark.createDataFrame([(1, [1.0, 0.0], "a"), (2, [0.0, 1.0], "b")], "vec_id long, embedding array<double>, hash string")
    assert store.count() == 0 and store.put(rows) == 2 and store.put(rows) == 0 and store.count() == 2
    assert store.find_nearest(F.array(F.lit(0.0), F.lit(1.0)), 1).first().vec_id == 2 and store.get(1).count() == 1
    observed, seen = D.observed_dimensions(store.rows(), 3)
    assert observed.count() == 2 and seen.get == {"seen": 2, "wrong": 2}
    assert store.clear() and store.count() == 0
    entries = spark.createDataFrame([("1", 1, "Kata", "kata"), ("2", 2, "KATA", "kata"), ("3", 3, "a", "a")], "id string, doc_id long, lema string, lema_lc string")
    assert D.by_lema(entries, " KaTa ").first().id == "2" and [r.id for r in D.all_entries(entries).collect()] == ["3", "2"] and D.by_id(entries, "3").count() == 1


def test_dependencies_are_made_once_and_replaced():
    made = []
    deps = D.Dependencies(client=lambda: made.append(1) or "real")
    assert deps.get("client") == deps.get("client") == "real" and made == [1]
    with deps.overridden(client="fake"):
        assert deps.get("client") == "fake"
    assert deps.get("client") == "real" and deps.describe() == {"name": "leksika", "provides": ["client"]}
    with pytest.raises(Refused):
        deps.get("other")
    D.refuse_canonical("/data/projections", "/data/canonical")
    with pytest.raises(Refused):
        D.refuse_canonical("/data/canonical/x", "/data/canonical/")


class Held:
    def __init__(self, values):
        self.values = values


def test_embedding_client_shapes_and_retries(spark):
    assert [E.values_of(a) for a in ([1, 2], {"values": [1, 2]}, {"embedding": {"values": [1, 2]}}, Held([1, 2]))] == [[1.0, 2.0]] * 4
    calls, waits = [], []

    def flaky(texts):
        calls.append(texts)
        if len(calls) < 3:
            raise TimeoutError
        return [[1.0]] * len(texts)

    assert E.ask(flaky, ["a", "b"], 1, sleep=waits.append) == [[1.0], [1.0]] and waits == [0.5, 1.0]
    with pytest.raises(ValueError):
        E.ask(lambda texts: [[1.0, 2.0]], ["a"], 1)
    with pytest.raises(TimeoutError):
        E.ask(lambda texts: (_ for _ in ()).throw(TimeoutError()), ["a"], 1, 1, waits.append)
    embed = E.embedding(lambda: lambda texts: [{"values": [float(len(t)), 0.0]} for t in texts], 2, batch=2)
    rows = spark.createDataFrame([("a",), ("bb",), (None,), (" ",), ("ccc",)], "t string")
    assert [r.v for r in rows.coalesce(1).select(embed("t").alias("v")).collect()] == [[1.0, 0.0], [2.0, 0.0], None, None, [3.0, 0.0]]


def test_secrets_are_masked(spark):
    secret = {k: "s" for k in ("Cookie", "session_id", "passwd", "private-key", "private_key", "API_KEY", "refresh_token", "Authorization")}
    assert set(masked(secret).values()) == {"[REDACTED]"} and masked({"lema": "s", "deep": [{"cookie": 1}]}) == {"lema": "s", "deep": [{"cookie": "[REDACTED]"}]}
    found = spark.range(1).select(X.redacted(F.create_map(*[F.lit(x) for p in secret.items() for x in p])).alias("m")).first().m
    assert set(found.values()) == {"[REDACTED]"}


def test_requests_share_their_rate(spark, monkeypatch):
    words = spark.createDataFrame([("a",)], "lema string")
    with pytest.raises(ValueError):
        web.fetch(words, "http://h", tasks=web.CONCURRENT + 1)
    assert X.backoff(F.lit(2), jitter=F.lit(1.0)) is not None
    assert spark.range(1).select(X.backoff(F.lit(2), jitter=F.lit(1.0)).alias("b")).first().b == pytest.approx(2.2)


def test_quarantine_is_appended_read_and_cleared(spark, tmp_path):
    path = str(tmp_path / "quarantine")
    assert sinks.quarantined(spark, path) is None
    rows = spark.createDataFrame([("1", "empty_makna"), ("2", "hash_mismatch")], "id string, reason string")
    sinks.quarantine(rows, path)
    sinks.quarantine(rows.limit(1), path)
    assert sinks.quarantined(spark, path).count() == 3 and sinks.quarantined(spark, path, "hash_mismatch").first().id == "2"
    assert sinks.remove(spark, path) and sinks.quarantined(spark, path) is None


def test_refusals_and_times(spark):
    assert Refused("conflict", "no").to_dict() == {"error": "conflict", "status": 409, "message": "no"}
    assert spark.range(1).select(X.iso_now().alias("t")).first().t.endswith("Z")
