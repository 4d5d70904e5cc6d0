"""Projection artifacts: one whole unit for each identity, told by its bytes."""

import threading

import pytest

from leksika.sources import artifacts as A
from leksika.sources import sinks

WORD = A.Identity("web", "word", "r1", "gen-1", "word-v1")


def put(spark, root, n=20, identity=WORD, source="0" * 64):
    return A.publish_artifact(spark.range(n), root, identity, ["id"], n, source)


def listed(spark, root):
    return {r.folder: (r.verified, r.reason) for r in A.artifacts(spark, root).collect()}


def test_same_identity_fails_closed(spark, tmp_path):
    root = str(tmp_path)
    assert put(spark, root) and not put(spark, root)
    for other in ({"n": 21}, {"n": 19}, {"source": "1" * 64}):
        with pytest.raises(sinks.Conflict):
            put(spark, root, **other)
    assert A.read_artifact(spark, root, WORD).count() == 20 and listed(spark, root) == {"/" + "/".join(WORD): (True, None)}
    assert A.manifest_of(spark, root, WORD)["source_count"] == 20


def test_two_writers_leave_one_whole_artifact(spark, tmp_path):
    results = {}

    def writer(n):
        try:
            results[n] = put(spark, str(tmp_path), n)
        except sinks.Conflict:
            results[n] = "conflict"

    threads = [threading.Thread(target=writer, args=(n,)) for n in (30, 40, 50)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    won = [n for n, r in results.items() if r is True]
    assert len(won) == 1 and sorted(map(str, results.values())) == ["True", "conflict", "conflict"]
    assert A.read_artifact(spark, str(tmp_path), WORD).count() == won[0] and not list(tmp_path.glob("_staging/*")) and not list(tmp_path.rglob("*.lock"))


def test_what_is_tampered_with_is_not_listed(spark, tmp_path):
    root, names = str(tmp_path), {}
    for n, what in enumerate(("sound", "byte", "more", "less", "no data", "no manifest", "moved")):
        names[what] = A.Identity("web", "word", f"r{n}", "gen-1", "word-v1")
        assert put(spark, root, identity=names[what])
    at = {what: tmp_path.joinpath(*name) for what, name in names.items()}
    for crc in tmp_path.rglob("*.crc"):
        crc.unlink()
    first = lambda what: sorted(at[what].glob("data/*.parquet"))[0]
    data = bytearray(first("byte").read_bytes())
    data[10] ^= 1
    first("byte").write_bytes(data)
    (at["more"] / "data/part-more.parquet").write_bytes(first("sound").read_bytes())
    first("less").unlink()
    for f in (at["no data"] / "data").iterdir():
        f.unlink()
    (at["no manifest"] / "manifest.json").unlink()
    at["moved"].rename(at["moved"].with_name("word-v2"))
    found = {f.split("/")[3] + f.split("/")[5]: r for f, r in listed(spark, root).items()}
    mismatch = (False, "output_hash_mismatch")
    assert found == {
        "r0word-v1": (True, None), "r1word-v1": mismatch, "r2word-v1": mismatch, "r3word-v1": (False, "artifact_missing") if not list(at["less"].glob("data/*.parquet")) else mismatch, "r4word-v1": (False, "artifact_missing"),
        "r5word-v1": (False, "manifest_missing"), "r6word-v2": (False, "manifest_invalid: identity"),
    }
    for what in ("byte", "no manifest", "moved"):
        with pytest.raises(FileNotFoundError):
            A.read_artifact(spark, root, names[what])
    with pytest.raises(sinks.Conflict):  # it isn't what its manifest says, and isn't replaced
        put(spark, root, identity=names["byte"])


def test_names_are_no_paths(spark, tmp_path):
    for bad in (WORD._replace(consumer=".."), WORD._replace(source_release="a/b"), WORD._replace(consumer=""), WORD._replace(schema_version="word-v9"), WORD._replace(track="other")):
        with pytest.raises(ValueError):
            put(spark, str(tmp_path), identity=bad)
    assert put(spark, str(tmp_path), 0) and A.read_artifact(spark, str(tmp_path), WORD).count() == 0
