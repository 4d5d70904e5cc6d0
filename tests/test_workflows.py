import base64
import hashlib
import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F

from leksika.functions.keys import normalise
from leksika.operators import pointers
from leksika.plans import workflows
from leksika.sources import artifacts, catalogs, sinks, web


def page(word, sense="definisi yang cukup panjang"):
    return f"<entry><h1>{word}</h1><p class='makna'>{sense} {word}</p></entry>"


def entry(word, **change):
    html = page(word)
    digest = hashlib.sha256(html.encode()).hexdigest()
    source = {"url": f"https://kamus.example/entri/{word}", "source_kind": "official-live", "edition": "VI", "source_version": "VI", "retrieved_at": "2024-01-01T00:00:00Z", "content_hash": digest, "parser_version": "0.1.0"}
    transport = {"adapter": "fixture", "content": html, "content_type": "text/html; charset=utf-8", "expected_raw_hash": digest, "status": 200}
    out = {"stable_key": word, "source_ref": source | change.pop("source", {}), "transport": transport | change.pop("transport", {})}
    return {k: v for k, v in (out | change).items() if v is not None}


HOSTS = ("kamus.example",)


def write(tmp_path, items):
    path = tmp_path / "catalog.json"
    path.write_text(json.dumps({"catalog_id": "c", "corpus_version": "1", "entries": items}))
    return str(path)


BAD = [
    ("unknown_field", entry("a", extra=1)), ("ambiguous_alias", entry("b", stableKey="b")), ("invalid_key", entry("c", stable_key="../c")), ("key_collision", entry("d")), ("key_collision", entry("D", stable_key=" D ")),
    ("source_missing", entry("e")), ("unknown_source_field", entry("f", source={"odd": 1})), ("ambiguous_source_alias", entry("g", source={"sourceKind": "x"})), ("invalid_url", entry("h", source={"url": "https://[malformed/"})),
    ("invalid_source_hash", entry("i", source={"content_hash": "x"})), ("transport_missing", entry("j")), ("unknown_transport_field", entry("k", transport={"odd": 1})), ("ambiguous_transport_alias", entry("l", transport={"contentType": "text/html"})),
    ("invalid_adapter", entry("m", transport={"adapter": "http"})), ("invalid_status", entry("n", transport={"status": 99})), ("invalid_content_type", entry("o", transport={"content_type": "image/png"})), ("invalid_comparison_mode", entry("p", transport={"comparison_mode": "fuzzy"})),
    ("ambiguous_binding", entry("q", transport={"base64": "eA=="})), ("unsafe_path", entry("r", transport={"path": "../x"})), ("invalid_max_retries", entry("s", transport={"max_retries": 11})), ("hash_mismatch", entry("t", transport={"expected_raw_hash": "0" * 64})), (None, entry("u")),
]


def test_catalog_reasons(spark, tmp_path):
    gone = {"transport_missing": "transport", "source_missing": "source_ref"}
    items = [{k: v for k, v in e.items() if k != gone.get(r)} for r, e in BAD]
    found = catalogs.records(catalogs.entries(spark, write(tmp_path, items)), HOSTS)
    reasons = sorted((str(r.reason) for r in found.collect()))
    assert reasons == sorted(str(r) for r, _ in BAD)


def observation(word, role="evidence", **source):
    return {"role": role, "source_ref": entry(word, source=source)["source_ref"], "transport": entry(word)["transport"]}


def test_hosts_and_observations_of_a_catalog(spark, tmp_path):
    at = lambda host, word: {"url": f"https://{host}/entri/{word}"}
    cases = [
        ("unapproved_host", entry("a", source=at("other.example", "a"))), ("unapproved_host", entry("b", source={"url": "http://kamus.example/entri/b"})),
        ("unofficial_host", entry("c", source=at("cermin.example", "c"))), (None, entry("d", source=at("cermin.example", "d") | {"source_kind": "fallback"})),
        ("url_mismatch", entry("e", source=at("kamus.example", "f"))), (None, entry("Besar Sekali", source=at("kamus.example", "besar%20sekali"))),
        ("observations_not_a_list", entry("g", observations={"0": observation("g")})), ("repeated_observation", entry("h", observations=[observation("h"), observation("h", "official", edition="V")])),
        (None, entry("i", observations=[observation("i", "fallback"), observation("i", url="https://kamus.example/i/2"), observation("i", url="https://kamus.example/i/1", edition="V"), observation("i", url="https://kamus.example/i/1", source_kind="fallback")])),
    ]
    found = catalogs.records(catalogs.entries(spark, write(tmp_path, [e for _, e in cases])), HOSTS, ("cermin.example",))
    reasons = {r.stable_key: r.reason for r in found.collect()}
    assert reasons == {e["stable_key"].lower(): r for r, e in cases}
    placed = catalogs.bindings(found.where("stable_key = 'i'")).orderBy("place").collect()
    assert [(r.place, r.role, r.source.url[-3:], r.source.source_kind) for r in placed] == [
        (0, "primary", "i/i", "official-live"), (1, "evidence", "i/1", "fallback"), (2, "evidence", "i/1", "official-live"), (3, "evidence", "i/2", "official-live"), (4, "fallback", "i/i", "official-live"),
    ]


def test_run_of_a_catalog(spark, tmp_path):
    words = [f"kata{i:03}" for i in range(8)]
    items = [entry(w) for w in words[:3]]
    items += [entry(words[3], transport={"status": 503}), entry(words[4], transport={"status": 404}), entry(words[5], transport={"content": page("lain")}, observations=[{"role": "evidence", "source_ref": entry(words[5])["source_ref"], "transport": entry(words[5])["transport"]}])]
    items += [entry(words[6], source={"source_kind": "fallback"}), entry("zzz", transport={"content": None, "base64": base64.b64encode(page("zzz").encode()).decode(), "expected_raw_hash": hashlib.sha256(page("zzz").encode()).hexdigest()})]
    items[-1]["transport"].pop("content")
    results = workflows.run_catalog(spark, write(tmp_path, list(reversed(items))), official=HOSTS)
    outcomes = {r.stable_key: r.outcome for r in results["outcomes"].collect()}
    assert outcomes == {words[0]: "accepted", words[1]: "accepted", words[2]: "accepted", words[3]: "retryable", words[4]: "quarantined", words[5]: "accepted", words[6]: "quarantined", "zzz": "accepted"}
    assert results["rejected"].count() == 0
    report = results["report"].first()
    assert (report.terminal, report.pending, report.complete, report.blocked) == (7, 1, False, True)
    assert results["conservation"].first().conserved
    assert results["observations"].where(F.col("stable_key") == words[5]).count() == 2


def test_import_and_release(spark, tmp_path):
    rows = [(f"r{i}", page(w).encode(), f"https://k/{w}") for i, w in enumerate(("Satu", "Dua", "Tiga"))] + [("bad", b"", "https://k/x")]
    snapshots = spark.createDataFrame(rows, "raw_snapshot_id string, content binary, url string")
    good, bad = workflows.import_snapshots(snapshots, "official-live")
    assert {r.id for r in good.collect()} == {"satu", "dua", "tiga"}
    assert {r.raw_snapshot_id: r.reason for r in bad.collect()} == {"bad": "parse: raw_bytes is empty"}
    assert {r.reason for r in workflows.import_snapshots(snapshots, "enrichment")[1].collect()} == {"authority_violation", "parse: raw_bytes is empty"}

    candidate = workflows.with_document(good.select("id", "lema", "makna", "kelas_kata", "contoh", "bentuk_tidak_baku"))
    prior = candidate.where("id <> 'tiga'").select("id", F.when(F.col("id") == "dua", "old").otherwise(F.col("hash")).alias("hash"))
    stored = candidate.where("id = 'satu'").select("id", F.array(F.lit(1.0), F.lit(0.0)).alias("embedding"))
    plan, vectors = workflows.build_release(prior, candidate, stored, 2)
    assert {r.id: r["class"] for r in plan.collect()} == {"satu": "unchanged", "dua": "changed", "tiga": "new"}
    built = {r.id: r for r in vectors.collect()}
    assert built["satu"].reused and list(built["satu"].embedding) == [1.0, 0.0] and not built["dua"].reused
    manifest = candidate.select("id", "hash")
    records = vectors.join(manifest.withColumnRenamed("hash", "content_hash"), "id").select("id", "content_hash", "embedding")
    assert workflows.verify_release(manifest, records, 2).count() == 0
    tampered = records.where("id <> 'dua'").unionAll(records.where("id = 'satu'")).unionAll(spark.createDataFrame([("more", "x", [1.0, 2.0])], records.schema))
    assert {(r.id, r.problem) for r in workflows.verify_release(manifest, tampered, 2).collect()} == {("dua", "missing"), ("more", "extra"), ("satu", "duplicate")}
    assert {r.problem for r in workflows.verify_release(manifest, records.withColumn("embedding", F.array(F.lit(float("inf")))), 2).collect()} == {"dimensions", "not_finite"}


def test_publication_is_once(spark, tmp_path):
    schema = "id string, lema string, bentuk_tidak_baku array<string>, bentuk_baku string, kelas_kata array<string>, status string, source_kind string, source_url string, raw_content_hash string"
    entries = spark.createDataFrame([("1", "Baku", ["x"], None, ["n"], "active", "official-live", "https://h/1", "a" * 64)], schema)
    one = workflows.publish_tracks(entries, str(tmp_path), "web", "r1", "gen-1")
    two = workflows.publish_tracks(entries, str(tmp_path), "web", "r1", "gen-1")
    assert (one, two) == ({"word": True, "relations": True}, {"word": False, "relations": False})
    name = artifacts.Identity("web", "relations", "r1", "gen-1", "relations-v1")
    assert artifacts.read_artifact(spark, str(tmp_path), name).first()["to"] == "Baku" and artifacts.manifest_of(spark, str(tmp_path), name)["output_count"] == 1
    with pytest.raises(sinks.Conflict):  # another source for the same identity
        workflows.publish_tracks(entries.withColumn("lema", F.lit("Other")), str(tmp_path), "web", "r1", "gen-1")
    assert artifacts.read_artifact(spark, str(tmp_path), name).first()["to"] == "Baku"


def approval(digest):
    return {"reviewer": "r", "reason": "ok", "policy": "p", "target_manifest_hash": digest}


def verify(version):
    return {"r1": {"valid": True, "manifest_hash": "h1"}, "r2": {"valid": True, "manifest_hash": "h2"}, "bad": {"valid": False, "manifest_hash": "h3"}}[version]


def test_pointer(spark, tmp_path):
    registry = pointers.Registry(spark, str(tmp_path / "registry"))

    def refused(kind, *args):
        with pytest.raises(pointers.Refused) as error:
            registry.change(*args, verify)
        assert error.value.kind == kind

    refused("not_found", "promote", "r2", ("r1", "gen-1"), approval("h2"), "o0")
    registry.seed("r1", "h1")
    refused("conflict", "promote", "r2", ("r1", "gen-7"), approval("h2"), "o1")
    refused("not_found", "promote", "r9", ("r1", "gen-1"), approval("h2"), "o1")
    refused("verification_failed", "promote", "bad", ("r1", "gen-1"), approval("h3"), "o1")
    refused("approval_required", "promote", "r2", ("r1", "gen-1"), approval("h1"), "o1")
    refused("approval_required", "promote", "r2", ("r1", "gen-1"), {"target_manifest_hash": "h2"}, "o1")
    event = registry.change("promote", "r2", ("r1", "gen-1"), approval("h2"), "o1", verify)
    assert (event["generation"], registry.current()["to_version"]) == ("gen-2", "r2")
    assert registry.change("promote", "r2", ("r1", "gen-1"), approval("h2"), "o1", verify)["idempotent"]
    refused("not_found", "rollback", "r2", ("r2", "gen-2"), approval("h2"), "o2")
    registry.change("rollback", "r1", ("r2", "gen-2"), approval("h1"), "o3", verify)
    refused("conflict", "promote", "r2", ("r1", "gen-1"), approval("h2"), "o4")  # current again, but of a later generation
    events = registry.history()
    assert [(e["from_version"], e["to_version"]) for e in events] == [(None, "r1"), ("r1", "r2"), ("r2", "r1")]
    assert len(registry.audit.records()) == 8


def test_racing_promotions_have_one_winner(spark, tmp_path):
    root = str(tmp_path / "registry")
    pointers.Registry(spark, root).seed("r1", "h1")
    results = []

    def promote(i):
        try:
            results.append(pointers.Registry(spark, root).change("promote", "r2", ("r1", "gen-1"), approval("h2"), f"o{i}", verify)["generation"])
        except pointers.Refused as error:
            results.append(error.kind)

    threads = [threading.Thread(target=promote, args=(i,)) for i in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(results) == ["conflict"] * 3 + ["gen-2"]


def test_idempotency_and_lease(spark, tmp_path):
    keys = pointers.Idempotency(spark, str(tmp_path / "keys"))
    assert keys.bind("k", "f1", "run-1") == "run-1" and keys.bind("k", "f1", "run-2") == "run-1"
    with pytest.raises(pointers.Refused):
        keys.bind("k", "f2", "run-3")
    lease = pointers.Lease(spark, str(tmp_path / "lease"))
    first = lease.acquire("a", 0.0)
    lease.check(first, 10.0)
    with pytest.raises(pointers.Refused):
        lease.acquire("b", 30.0)
    second = lease.acquire("b", 61.0)
    lease.check(second, 62.0)
    with pytest.raises(pointers.Refused):
        lease.check(first, 62.0)


@pytest.mark.parametrize("value", [0, 101, True, "x", "1.5", 2.0])
def test_limits(value):
    assert [pointers.limit_of(v) for v in (None, 5, " 7 ", "+8")] == [100, 5, 7, 8]
    with pytest.raises(pointers.Refused):
        pointers.limit_of(value)


def test_selectors_and_paths():
    errors = lambda *a, **k: pointers.selector_errors(*a, consumers=("web",), rejected=("hunspell-aff",), **k)
    assert errors("web", "word", "2024-01-01.1") == []
    assert len(errors("other", "hunspell-aff", "../x")) == 3
    assert errors("web", "word", "r", schema="relations-v1") and errors("", "word", "r")
    assert pointers.inside("/root", "a/../b") and not pointers.inside("/root", "a/../../b") and not pointers.inside("/root", "/etc") and not pointers.inside("/root", "gs://x")


@pytest.mark.parametrize(("given", "key", "problem"), [("  STRAßE　x ", "strasse x", None), ("ﬁ", "fi", None), ("a/b", None, "path-like"), ("http://x", None, "url"), ("a​b", None, "control character"), (" ", None, "blank"), ("x" * 257, None, "too long"), (None, None, "missing")])
def test_keys(given, key, problem):
    assert normalise(given) == (key, problem)


def test_fetch_retries_and_limits(spark, monkeypatch):
    calls = []

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            calls.append(self.path)
            status = 404 if "gone" in self.path else 503 if calls.count(self.path) < 3 and "busy" in self.path else 200
            self.send_response(status)
            self.send_header("Retry-After", "0.01")
            self.end_headers()
            self.wfile.write(page("kata").encode() if status == 200 else b"")

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    monkeypatch.setitem(web.RATES, "test", 1000.0)
    try:
        words = spark.createDataFrame([("kata kerja",), ("busy",), ("gone",)], "lema string")
        found = {r.lema: r for r in web.fetch(words, f"http://127.0.0.1:{server.server_port}/entri", "test").collect()}
    finally:
        server.shutdown()
    assert "/entri/kata%20kerja" in calls
    assert (found["kata kerja"].status, found["kata kerja"].attempts) == (200, 1)
    assert (found["busy"].status, found["busy"].attempts) == (200, 3)
    assert (found["gone"].status, found["gone"].content, found["gone"].error) == (404, None, "status 404")
    assert found["busy"].content_hash == hashlib.sha256(page("kata").encode()).hexdigest()


def test_token_bucket():
    now, slept = [0.0], []

    def sleep(s):
        slept.append(s)
        now[0] += s

    bucket = web.TokenBucket(2.0, 1, lambda: now[0], sleep)
    for _ in range(3):
        bucket.take()
    assert slept == [0.5, 0.5]
