import pytest
from pyspark.sql import functions as F

from leksika.operators import checkpoint as C
from leksika.operators import parsing, projections, releases, retrieval, validation
from leksika.sources import sinks, tables
from leksika.streaming import runs

HTML = b"""<html><head><title>x - y</title></head><body><nav><ul><li>Beranda situs</li></ul></nav><h2 class='lema'>Februari 1</h2><span class='kelas-kata'>n</span>
<div class='makna'><ol><li>1. bulan ke-2 tahun Masehi<br>(kedua) contoh: x</ol></div><div class='contoh'><i>contoh: Ia lahir bulan Februari.</i></div>
<div class='bentukTidakBaku'>bentuk tidak baku: Pebruari, Pebroari.</div></body></html>"""


def test_html(spark):
    rows = [("r1", HTML, "https://h/e/februari"), ("r2", b"", "u"), ("r3", b"\xff\xfe", "u"), ("r4", b"<p>definisi sesuatu di sini</p>", "https://h/e/kata"), ("r5", None, None)]
    found = {r.raw_snapshot_id: r for r in parsing.html_entries(spark.createDataFrame(rows, "raw_snapshot_id string, content binary, url string")).collect()}
    entry = found["r1"]
    assert (entry.id, entry.lema, entry.kelas_kata, entry.error) == ("februari", "Februari", ["n"], None)
    assert entry.makna == ["bulan ke-2 tahun Masehi (kedua)"]
    assert entry.contoh == ["Ia lahir bulan Februari."]
    assert entry.bentuk_tidak_baku == ["Pebruari", "Pebroari"]
    assert found["r2"].error and found["r3"].error and found["r5"].error
    assert (found["r4"].lema, found["r4"].makna) == ("Kata", ["definisi sesuatu di sini"])


def test_json_and_dispatch(spark):
    rows = [
        ("j1", b'{"Lemma": "Februari", "makna": [{"definisi": "bulan kedua"}, "lagi"], "kelas": "n, v", "nonstandard": ["Pebruari"]}', "u"),
        ("j2", b'[{"kata": "x", "arti": "sesuatu"}]', "u"), ("j3", b'{"kata": "x"}', "u"), ("h", HTML, "u"), ("broken", b"{not json <p>paragraf yang cukup</p>", "https://h/kata"),
    ]
    found = {r.raw_snapshot_id: r for r in parsing.parse(spark.createDataFrame(rows, "raw_snapshot_id string, content binary, url string")).collect()}
    assert (found["j1"].lema, found["j1"].makna, found["j1"].kelas_kata, found["j1"].bentuk_tidak_baku) == ("Februari", ["bulan kedua", "lagi"], ["n", "v"], ["Pebruari"])
    assert found["j2"].makna == ["sesuatu"]
    assert found["j3"].error == "makna not found"
    assert found["h"].lema == "Februari"
    assert found["broken"].error is None


def test_parsing_is_deterministic(spark, sf):
    pages = tables.read(spark, sf, "pages").select(F.col("page_id").alias("raw_snapshot_id"), F.encode("html", "UTF-8").alias("content"), "url")
    assert parsing.replay_differences(parsing.html_entries(pages), parsing.html_entries(pages.repartition(3))).count() == 0


LADDER = [
    ({"source_kind": "nowhere"}, "unknown_source_kind"), ({"source_kind": "enrichment"}, "authority_violation"), ({"source_kind": "ai-proposal"}, "authority_violation"), ({"makna": []}, "empty_makna"),
    ({"status": "gone"}, "invalid_status"), ({"review_status": "odd"}, "invalid_review_status"), ({"content_hash": "XYZ"}, "invalid_content_hash"), ({"raw": "other"}, "hash_mismatch"), ({"parser_version": "0.2.0"}, "parser_version_mismatch"), ({}, None),
]


def test_first_failure_wins(spark):
    import hashlib

    good = {"source_kind": "official-live", "makna": ["x"], "status": "active", "review_status": "pending", "content_hash": hashlib.sha256(b"raw").hexdigest(), "parser_version": "0.1.0", "source_parser_version": "0.1.0", "raw": "raw"}
    rows = [tuple((good | change).values()) for change, _ in LADDER]
    df = spark.createDataFrame(rows, "source_kind string, makna array<string>, status string, review_status string, content_hash string, parser_version string, source_parser_version string, raw string")
    found = [r[0] for r in df.coalesce(1).select(validation.entry_failure(F.sha2("raw", 256))).collect()]
    assert found == [reason for _, reason in LADDER]


def test_delta_plan_golden(spark):
    side = lambda rows: spark.createDataFrame(rows, "id string, hash string")
    plan = releases.delta_plan(side([("a", "1"), ("b", "1"), ("c", "1"), ("f", "1")]), side([("b", "1"), ("c", "2"), ("d", "1"), ("f", "1")]), side([("f", "")]), side([("e", "")]))
    assert {r.id: r["class"] for r in plan.collect()} == {"a": "removed", "b": "unchanged", "c": "changed", "d": "new", "e": "excluded", "f": "changed"}


def test_chunks_of_501(spark):
    counts = releases.chunks(spark.range(501).repartition(5), "id").groupBy("chunk").count().collect()
    assert {r.chunk: r["count"] for r in counts} == {0: 500, 1: 1}


def test_vector_violations(spark):
    rows = [([1.0, 2.0], "a" * 64, "r"), ([1.0], "a" * 64, "r"), ([1.0, float("inf")], "a" * 64, "s"), ([1.0, 2.0], "no", "r")]
    df = spark.createDataFrame(rows, "embedding array<double>, content_hash string, version string").coalesce(1)
    assert [r[0] for r in df.select(validation.vector_violations(2, "r")).collect()] == [[], ["dimensions"], ["not_finite", "version"], ["content_hash"]]


def test_create_only(spark, tmp_path):
    rows = lambda *r: spark.createDataFrame(list(r), "id string, hash string")
    path = str(tmp_path / "vectors")
    assert sinks.create_only(rows(("a", "1"), ("b", "1")), path) == 2
    assert sinks.create_only(rows(("a", "1"), ("c", "1")), path) == 1
    assert sinks.create_only(rows(("a", "1")), path) == 0
    with pytest.raises(sinks.Conflict):
        sinks.create_only(rows(("a", "2"), ("d", "1")), path)
    assert spark.read.parquet(path).count() == 3


def test_create_only_refuses_conflicts_within_a_batch(spark, tmp_path):
    rows = lambda *r: spark.createDataFrame(list(r), "id string, hash string, n int")
    path = str(tmp_path / "vectors")
    for bad in (rows(("a", "1", 1), ("a", "2", 1)), rows(("a", "1", 1), ("a", None, 1))):
        with pytest.raises(sinks.Conflict):
            sinks.create_only(bad, path)
        assert not sinks.exists(spark, path)
    assert sinks.create_only(rows(("a", "1", 1), ("a", "1", 1), ("b", None, 2)), path) == 2
    assert sinks.create_only(rows(("b", None, 2)), path) == 0


def test_batch_of_501_fails_in_its_second_chunk_and_is_completed(spark, tmp_path):
    rows = spark.range(501).select(F.format_string("e%03d", "id").alias("id"), F.sha2(F.col("id").cast("string"), 256).alias("hash"))
    path, ledger = str(tmp_path / "vectors"), str(tmp_path / "ledger")
    first = sinks.persist_batch(rows.unionAll(rows.limit(3)), path, ledger, "b1", fail_chunk=1)
    assert first == {"records": 501, "chunks": 2, "committed_chunks": 1, "open_chunks": 1, "status": "partial", "eligible": False}
    assert spark.read.parquet(path).count() == 500
    again = sinks.persist_batch(rows, path, ledger, "b2")
    assert (again["status"], again["committed_chunks"], again["eligible"]) == ("complete", 2, True) and spark.read.parquet(path).count() == 501
    bad = rows.withColumn("hash", F.when(F.col("id") == "e007", "other").otherwise(F.col("hash")))
    assert sinks.persist_batch(bad, path, ledger, "b3")["status"] == "conflict" and spark.read.parquet(path).count() == 501
    kept = {(r.batch_id, r.chunk): (r.size, r.written, r.status) for r in spark.read.parquet(ledger).collect()}
    assert kept == {("b1", 0): (500, 500, "committed"), ("b1", 1): (1, 1, "failed"), ("b2", 0): (500, 0, "committed"), ("b2", 1): (1, 1, "committed"), ("b3", 0): (500, 0, "refused"), ("b3", 1): (1, 0, "refused")}


def test_chunks_by_ranges_are_those_of_ranks(spark):
    import random

    rng = random.Random(2)
    numbers = [rng.randrange(10**6) for _ in range(700)] + [5] * 90
    for kind, keys in (("long", [None, *numbers]), ("string", [None, *map(str, numbers)])):
        found = releases.chunks(spark.createDataFrame([(k,) for k in keys], f"k {kind}").repartition(4), "k", 50, ranges=9).collect()
        order = sorted(keys, key=lambda k: (k is not None, k))
        assert sorted((r.chunk, r.k is not None, r.k or 0) for r in found) == sorted((i // 50, k is not None, k or 0) for i, k in enumerate(order)) if kind == "long" else len(found) == 791
        assert sorted(r.chunk for r in found) == [i // 50 for i in range(791)]


def test_a_failed_publication_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "track")

    def fail_at(step):
        def fault(now):
            if now == step:
                raise RuntimeError(step)

        return fault

    for step in ("stage", "verify", "rename"):
        with pytest.raises(RuntimeError):
            sinks.publish(spark.range(10), path, ["id"], fail_at(step))
        assert not any(tmp_path.glob("track*"))
    (tmp_path / "track.lock").touch()
    with pytest.raises(sinks.Conflict):
        sinks.publish(spark.range(10), path, ["id"])
    (tmp_path / "track.lock").unlink()
    assert sinks.publish(spark.range(10), path, ["id"]) and not (tmp_path / "track.lock").exists()


def test_publish_once(spark, tmp_path):
    path = str(tmp_path / "track")
    assert sinks.publish(spark.range(10), path, ["id"])
    assert not sinks.publish(spark.range(10).repartition(3), path, ["id"])
    with pytest.raises(sinks.Conflict):  # other content for a published path fails closed
        sinks.publish(spark.range(3), path, ["id"])
    assert spark.read.parquet(path).count() == 10


def test_a_writer_that_comes_second_destroys_nothing(spark, tmp_path):
    """The second writer had asked before the first had finished: it finds the first one's rows under the lock, or at the rename."""
    path = str(tmp_path / "track")

    def other_writer(now):
        if now == "rename":  # another writer, whose lock counts as that of a dead one, takes the path meanwhile
            (tmp_path / "track.lock").unlink()
            assert sinks.publish(spark.range(7), path, ["id"])

    with pytest.raises(sinks.Conflict):
        sinks.publish(spark.range(10), path, ["id"], other_writer)
    assert spark.read.parquet(path).count() == 7 and sorted(p.name for p in tmp_path.iterdir()) == ["track"]


def test_the_lock_of_a_dead_writer_expires(spark, tmp_path):
    import os

    path = str(tmp_path / "track")
    (tmp_path / "track.lock").touch()
    os.utime(tmp_path / "track.lock", (1, 1))
    (tmp_path / "track.staging-dead").mkdir()
    assert sinks.publish(spark.range(4), path, ["id"]) and sinks.cleanup(spark, path)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["track"]


def test_nearest_batch_of_copies_and_lengths(spark):
    """Ties go by id in a block already; of two lengths the shorter counts."""
    from leksika.operators import retrieval

    rows = [(i, [1.0, 0.0]) for i in range(300)] + [(300, [2.0]), (301, [1.0, 0.0, 5.0]), (302, [])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(7)
    queries = spark.createDataFrame([(-1, [1.0, 1.0]), (-2, [3.0])], "query_id long, query array<double>")
    found = lambda m: {(r.query_id, r["rank"]): (r.vec_id, round(r.distance, 6)) for r in retrieval.nearest_batch(queries, vectors, 3, m).collect()}
    assert found("DOT_PRODUCT") == {(-1, 1): (300, -1.0), (-1, 2): (0, 0.0), (-1, 3): (1, 0.0), (-2, 1): (300, -5.0), (-2, 2): (0, -2.0), (-2, 3): (1, -2.0)}
    assert found("EUCLIDEAN") == {(-1, 1): (302, 0.0), (-1, 2): (0, 1.0), (-1, 3): (1, 1.0), (-2, 1): (302, 0.0), (-2, 2): (300, 1.0), (-2, 3): (0, 2.0)}


def test_blocks_are_dealt_evenly(spark):
    """Few rows in each of many partitions: groups are about as large as each other."""
    from leksika.sources.blocks import group_of

    rows = spark.range(4000).repartition(2000)
    sizes = [r["count"] for r in rows.select(group_of(4).alias("g")).groupBy("g").count().collect()]
    assert len(sizes) == 4 and min(sizes) > 850


def test_embedding_document(spark):
    columns = {"lema": F.lit(" <b>Februari</b> "), "ejaan": F.lit(None).cast("string"), "kelas_kata": F.array(F.lit("n")), "makna": F.array(F.lit("bulan"), F.lit(" "), F.lit("kedua")), "contoh": F.array().cast("array<string>")}
    assert spark.range(1).select(projections.embedding_document(columns)).first()[0] == "Lema: Februari\nKelas Kata: n\nMakna: (1) bulan; (3) kedua"


ENTRY = "id string, lema string, bentuk_tidak_baku array<string>, bentuk_baku string, kelas_kata array<string>, status string, source_kind string, source_url string, raw_content_hash string"


def entries_of(spark, *rows):
    """Entries of (id, lema, variants, standard form) and, unless active and official, status and kind of source."""
    whole = [(*r[:4], ["v", "n"], *(r[4:] or ("active", "official-live")), "https://h/x", "a" * 64) for r in rows]
    return spark.createDataFrame(whole, ENTRY)


def test_relations_and_words_follow_the_contract(spark):
    entries = entries_of(
        spark, ("2", "Baku", ["x", "y", "y", " ", ""], None), ("1", "Baku", ["x", "Baku"], None), ("3", "Pebruari", None, "Februari"), ("4", "Februari", ["Pebruari"], " "),
        ("5", "lama", ["z"], "baru", "inactive", "official-live"), ("6", "cermin", ["z"], "baru", "active", "fallback"),
    )
    edges = projections.relations(entries, "r1")
    assert edges.columns == ["from", "to", "type", "source_entry_id", "canonical_field", "source_hash", "source_release"]
    found = {(r["from"], r.to): (r.source_entry_id, r.canonical_field) for r in edges.collect()}
    assert found == {("x", "Baku"): ("1", "bentuk_tidak_baku"), ("Baku", "Baku"): ("1", "bentuk_tidak_baku"), ("y", "Baku"): ("2", "bentuk_tidak_baku"), ("Pebruari", "Februari"): ("3", "bentuk_baku")}
    assert edges.where(F.size(projections.relation_failures("r1")) > 0).count() == 0
    words = projections.words(entries, "r1")
    assert words.columns == ["id", "lema", "source_entry_id", "canonical_content_hash", "raw_content_hash", "source_url", "source_kind", "source_release", "kelas_kata", "bentuk_baku", "bentuk_tidak_baku"]
    assert sorted(r.id for r in words.collect()) == ["1", "2", "3", "4"] and words.where("id = '3'").first().bentuk_tidak_baku == []
    assert words.where(F.size(projections.word_failures("r1")) > 0).count() == 0
    assert words.where(F.size(projections.word_failures("r2")) > 0).count() == 4


def test_selection_ignores_input_order(spark):
    rows = spark.createDataFrame([(f"entry-{i:03}",) for i in range(120)], "stable_key string")
    one, two = (C.selection(r).collect() for r in (rows, rows.orderBy(F.rand(1))))
    assert len(one) == 100 and sorted(one) == sorted(two)
    for bad in (0, -1, 101, 1000, True):
        with pytest.raises(ValueError):
            C.selection(rows, limit=bad)


def test_fingerprint_ignores_input_order(spark):
    rows = spark.createDataFrame([(str(i), "x" * i) for i in range(50)], "k string, v string")
    one, two = (C.fingerprint(r, "k", F.col("v")).first().fingerprint for r in (rows, rows.repartition(7)))
    assert one == two


def test_observation_ladder(spark):
    import hashlib

    good = hashlib.sha256(b"x").hexdigest().upper()
    rows = [(200, "x", good, None, True), (503, "x", good, None, True), (0, "x", good, None, True), (404, "x", good, None, True), (200, "y", good, None, True), (200, "x", good, "empty_makna", True), (200, "x", good, None, False), (200, None, good, None, True)]
    df = spark.createDataFrame(rows, "status int, content string, expected_hash string, entry_failure string, key_matches boolean").coalesce(1)
    assert [r[0] for r in df.select(C.observation_outcome()).collect()] == ["accepted", "retryable", "retryable", "failed", "quarantined", "quarantined", "quarantined", "failed"]


def test_conflict_diff(spark):
    rows = [("k", "official", "a", 1, 0), ("k", "evidence", "a", 1, 1), ("k", "evidence", "b", None, 2), ("m", "official", "a", 1, 0), ("m", "evidence", "a", 1, 1)]
    df = spark.createDataFrame(rows, "k string, tier string, lema string, n int, at int")
    found = validation.official_and_evidence(df, "k", "tier", ["lema", "n"], "at").collect()
    assert [(r.k, r.at, r.differs) for r in found] == [("k", 2, ["lema", "n"])]


def test_nearest_caps_and_thresholds(spark, sf):
    vectors = tables.vectors(spark, sf)
    query = F.array(*[F.lit(1.0 if i == 0 else 0.0) for i in range(64)])
    assert retrieval.nearest(vectors, query, 1000).count() == 50
    assert retrieval.nearest(vectors, query, 5, max_distance=-5.0).count() == 0
    hits = retrieval.nearest(vectors, query, 5, measure="EUCLIDEAN")
    assert retrieval.adapted(hits, 0.6).count() == 0


def test_cascade_stops_at_the_first_tier(spark):
    rows = [("1", 1, "feb", "feb", "active"), ("2", 2, "februari", "februari", "active"), ("3", 3, "febu", "febu", "inactive")]
    entries = spark.createDataFrame(rows, "id string, doc_id long, lema string, lema_lc string, status string").withColumn("source_kind", F.lit("official-live"))
    asked = spark.createDataFrame([("Feb",), ("febr",), ("fe",), ("zzz",)], "query string")
    assert {(r.query, r.id, r.tier) for r in retrieval.cascade(asked, entries).collect()} == {("Feb", "1", "exact"), ("febr", "2", "prefix")}


def test_cascade_goes_on_to_meaning(spark):
    """Queries that neither a word nor a beginning answers are embedded; hits are hydrated by word, id or what stands before the underscore, and filtered last."""
    rows = [("feb", 1, "feb", "active"), ("bulan", 2, "bulan", "active"), ("tua", 3, "tua", "inactive")]
    entries = spark.createDataFrame([(i, n, w, w, s) for i, n, w, s in rows], "id string, doc_id long, lema string, lema_lc string, status string").withColumn("source_kind", F.lit("official-live"))
    vectors = spark.createDataFrame([(1, "feb_r1", "", [1.0, 0.0]), (2, "zz", "Bulan", [0.9, 0.1]), (3, "tua", "", [1.0, 0.0]), (4, "gone", "", [1.0, 0.0]), (5, "feb", "", [0.0, 1.0])], "vec_id long, doc_id string, lema string, embedding array<double>")
    asked = spark.createDataFrame([("feb",), ("qqq",), ("  ",)], "query string")
    embed = lambda text: F.array(F.lit(1.0), F.lit(0.0))
    found = {(r.query, r.id, r.tier) for r in retrieval.cascade(asked, entries, 20, vectors, embed, 0.7).collect()}
    assert found == {("feb", "feb", "exact"), ("qqq", "feb", "semantic"), ("qqq", "bulan", "semantic")}
    assert retrieval.semantic(asked, entries, vectors, lambda t: F.lit(None).cast("array<double>")).count() == 0


def test_nearest_batch_is_brute_force(spark, sf, monkeypatch):
    monkeypatch.setattr(retrieval, "QUERY_BLOCK", 7)
    monkeypatch.setattr(retrieval, "VECTOR_BLOCK", 64)
    rows = tables.vectors(spark, sf).unionAll(spark.createDataFrame([(10_000 + i, [0.5] * 64, 0) for i in range(5)] + [(None, [1.0] * 64, 0), (20_000, None, 0)], "vec_id long, embedding array<double>, label long"))
    asked = rows.where("vec_id % 25 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    have = [(r.vec_id, r.embedding) for r in rows.collect() if r.vec_id is not None and r.embedding]
    for measure in ("DOT_PRODUCT", "COSINE", "EUCLIDEAN"):
        found = {}
        for r in retrieval.nearest_batch(asked, rows, 4, measure).orderBy("query_id", "rank").collect():
            found.setdefault(r.query_id, []).append((r.vec_id, round(r.distance, 9)))
        import numpy as np

        ids, x = np.array([i for i, _ in have]), np.array([v for _, v in have])
        for i, q in have:
            if i % 25 == 0:
                d = retrieval.distances(np.array([q]), x, measure)[0]
                order = [k for k in np.lexsort((ids, d)) if ids[k] != i][:4]
                assert [v for v, _ in found[i]] == ids[order].tolist()


def test_interrupted_and_resumed_is_uninterrupted(spark, sf, tmp_path):
    events = tables.read(spark, sf, "events")
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = ", ".join(f"{n} {t}" for n, t in events.dtypes)
    events.where("event_id < 500").coalesce(1).write.mode("append").parquet(source)
    runs.incremental(runs.event_stream(spark, source, schema), runs.append_once(out), str(tmp_path / "cp")).awaitTermination()
    events.where("event_id >= 500").coalesce(1).write.mode("append").parquet(source)
    runs.incremental(runs.event_stream(spark, source, schema), runs.append_once(out), str(tmp_path / "cp")).awaitTermination()
    read = spark.read.parquet(out).drop("batch")
    assert read.exceptAll(events).count() == 0 and read.count() == events.count()


def test_lifecycle_stream(spark, sf, tmp_path):
    events = tables.read(spark, sf, "events")
    source = str(tmp_path / "in")
    events.coalesce(1).write.parquet(source)
    states = runs.lifecycle(runs.event_stream(spark, source, ", ".join(f"{n} {t}" for n, t in events.dtypes)))
    query = states.writeStream.format("memory").queryName("lifecycle").outputMode("update").trigger(availableNow=True).start()
    query.awaitTermination()
    found = {r.user_id: r.state for r in spark.table("lifecycle").collect()}
    expected = {}
    for r in events.orderBy("ts", "event_id").collect():
        run, errors = expected.get(r.user_id, ("created", 0))
        if run not in ("completed", "failed"):
            errors = errors + 1 if r.event_type == "error" else 0
            run = "completed" if r.event_type == "purchase" else "failed" if errors > 3 else "interrupted" if errors else "running"
        expected[r.user_id] = (run, errors)
    assert found == {u: s for u, (s, _) in expected.items()}


def test_deep_markup_is_parsed(spark):
    """Nesting that a recursive walk can't follow; elements of many classes around each other."""
    page = "<b>" * 100_000 + "deep" + "<div class=makna><ol><li>satu dua tiga</li></ol></div>"
    many = "".join(f"<div class=c{i}>" for i in range(5_000)) + "<h1>kata</h1><nav><ol><li>menu utama</li></ol></nav><ol><li>arti kata</li></ol>"
    rows = spark.createDataFrame([("1", page.encode(), "https://x/entri/lema"), ("2", many.encode(), "https://x/entri/lain")], "raw_snapshot_id string, content binary, url string")
    found = {r.raw_snapshot_id: (r.lema, r.makna) for r in parsing.parse(rows).collect()}
    assert found == {"1": ("Lema", ["satu dua tiga"]), "2": ("kata", ["arti kata"])}


def test_preflight_keeps_whole_rows(spark):
    """Rows without a hash keep their columns, repeated ones are not mixed, and what disagrees is a conflict."""
    batch = spark.createDataFrame([("a", None, "x", 1), ("b", "h", "y", 2), ("b", "h", "z", 3), ("c", "h", "y", 1), ("c", None, "y", 1), ("d", "h", None, None)], "id string, hash string, payload string, n int")
    have = spark.createDataFrame([("d", "other")], "id string, hash string")
    found = {r.id: tuple(r)[1:] for r in releases.preflight(batch, have).collect()}
    assert found.pop("b") in (("h", "y", 2, "write"), ("h", "z", 3, "write"))
    assert found == {"a": (None, "x", 1, "write"), "c": ("h", "y", 1, "conflict"), "d": ("h", None, None, "conflict")}


def test_digests_in_order(spark, monkeypatch):
    """The tree of hashes by its rule, and the digest of all lines as hashlib makes it, from any partitions."""
    import hashlib

    from leksika.operators import ordered

    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    monkeypatch.setattr(ordered, "NODE", 7)
    for n in (0, 1, 7, 8, 60, 350):
        lines = [(f"k{i:04}", f"line {i} é") for i in range(n)] + [("k0000", "again")] * bool(n)
        level = [sha(v) for _, _, v in sorted((k, sha(v), v) for k, v in lines)]
        while len(level) > 1 or len(lines) == len(level) == 1:
            level = [sha("\n".join(level[i : i + 7])) for i in range(0, len(level), 7)]
            if len(level) == 1:
                break
        rows = spark.createDataFrame(lines, "k string, v string").repartition(5)
        assert tuple(ordered.tree_digest(rows, "k", F.col("v")).first()) == (len(lines), level[0] if level else sha(""))
        assert tuple(ordered.line_digest(rows, "k", line=F.col("v")).first()) == (len(lines), sha("\n".join(v for _, v in sorted(lines))))


def test_ranks_over_many_small_partitions(spark):
    from leksika.operators import ordered

    rows = spark.range(3000).select((F.col("id") * 7919 % 3001).alias("k")).repartition(60)
    assert sorted((r.k, r["rank"]) for r in ordered.ranked(rows, "k", ranges=40).collect()) == [(k, i) for i, k in enumerate(sorted(i * 7919 % 3001 for i in range(3000)))]


def test_a_hot_key_is_many_tasks(spark):
    """A key with most of the rows is parted by ranges; its sequence and lists are those of one sort."""
    from leksika.operators import ordered

    rows = spark.range(5000).select(F.when(F.col("id") % 10 < 8, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("k"), (F.col("id") * 7919 % 5003).alias("at"), F.concat(F.lit("a"), "id").alias("attempt_id")).repartition(9)
    placed = ordered.sequenced(rows, "k", "at", ranges=16)
    expected, seen = {}, {}
    for r in sorted(rows.collect(), key=lambda r: (r.k, r["at"])):
        expected[(r.k, r["at"])] = seen[r.k] = seen.get(r.k, 0) + 1
    assert {(r.k, r["at"]): r.sequence for r in placed.collect()} == expected
    assert rows.repartitionByRange(16, "k", "at").where("k = 'hot'").select(F.spark_partition_id()).distinct().count() > 10
    physical = rows.withColumn("outcome", F.when(F.col("at") % 100 == 3, "conflict").otherwise("failed")).withColumn("conflict_id", F.when(F.col("at") % 300 == 3, F.concat(F.lit("c"), F.lpad("at", 5, "0"))))
    logical, nested = C.logical_attempts(physical, "k", ["at"], "attempt_id", "outcome", "conflict_id", 50)
    hot = logical.where("k = 'hot'").first()
    assert (hot.attempt_count, hot.parts, hot.outcome) == (4000, 80, "conflict")
    lists = nested.where("k = 'hot'").collect()
    assert sorted(len(r.source_attempts) for r in lists) == [50] * 80
    assert {a.conflict_id for r in lists for a in r.source_attempts if a.outcome == "conflict"} == {hot.conflict_id}
    assert [a.sequence for r in sorted(lists, key=lambda r: r.part) for a in r.source_attempts] == list(range(1, 4001))
