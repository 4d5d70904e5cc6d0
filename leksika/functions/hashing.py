"""Hashes and identities. JSON is that of to_json with sorted keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fields of the two content hashes.
LEXICAL_FIELDS = ("bentuk_baku", "bentuk_tidak_baku", "contoh", "ejaan", "etimologi", "id", "kelas_kata", "labels", "lema", "makna", "pelafalan", "pemenggalan", "status", "sub_lema", "turunan")
SOURCE_FIELDS = ("content_hash", "edition", "parser_version", "retrieved_at", "source_kind", "source_version", "url")
RECORD_FIELDS = tuple(sorted((*LEXICAL_FIELDS, "confidence", "parser_version", "review_status", "source", "transform_version")))


def sha256(c: Column) -> Column:
    """F33."""
    return F.sha2(c, 256)


def canonical_json(fields: dict[str, Column]) -> Column:
    """a JSON object with sorted keys and nulls kept."""
    return F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]), {"ignoreNullFields": "false"})


def canonical_bytes(fields: dict[str, Column]) -> Column:
    """The UTF-8 bytes of the canonical JSON and a newline."""
    return F.encode(F.concat(canonical_json(fields), F.lit("\n")), "UTF-8")


def hash_valid(c: Column) -> Column:
    """Whether a text is a lower-case hex SHA-256."""
    return F.coalesce(c.rlike("^[0-9a-f]{64}$"), F.lit(False))


def lexical_hash(fields: dict[str, Column]) -> Column:
    """hash of lexical content; does not change with where or when an entry was read."""
    return sha256(canonical_json({k: v for k, v in fields.items() if k in LEXICAL_FIELDS}))


def record_hash(fields: dict[str, Column]) -> Column:
    """hash of the whole record, source and versions included, and a newline."""
    return sha256(F.concat(canonical_json({k: v for k, v in fields.items() if k in RECORD_FIELDS}), F.lit("\n")))


def identity(*parts: Column, prefix: str, digits: int = 32) -> Column:
    """``prefix-`` and the first digits of a hash over the parts."""
    return F.concat(F.lit(f"{prefix}-"), F.substring(sha256(F.concat_ws("|", *parts)), 1, digits))


def verified(content: Column, expected: Column) -> Column:
    """Whether content has the expected hash, in either case."""
    return sha256(content) == F.lower(expected)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body, or a lambda within, names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _norm(vector: Column) -> Column:
    zero = F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("c"))

    def add(acc: Column, x: Column) -> Column:
        total = acc["s"] + x
        lost = F.when(F.abs(acc["s"]) >= F.abs(x), (acc["s"] - total) + x).otherwise((x - total) + acc["s"])
        return F.struct(total.alias("s"), (acc["c"] + lost).alias("c"))

    return F.sqrt(F.aggregate(F.transform(vector, lambda x: x * x), zero, add, lambda acc: acc["s"] + acc["c"]))


def pseudo_vector(text: Column, dimensions: int = 768) -> Column:
    """a unit vector made of the text's hash; component i is (byte / 127.5 - 1) * 0.1 + (i mod 7) * 0.001.

    The norm's sum is compensated (Neumaier), so that it equals an exactly rounded sum in the last bit.
    """

    def component(digest: Column, i: Column) -> Column:
        byte = F.conv(F.substring(digest, (i % 32) * 2 + 1, F.lit(2)), 16, 10).cast("double")
        return (byte / 127.5 - 1.0) * 0.1 + (i % 7).cast("double") * 0.001

    places = F.sequence(F.lit(0), F.lit(dimensions - 1))
    unit = lambda raw: let(_norm(raw), lambda n: F.transform(raw, lambda x: F.when(n == 0, x).otherwise(x / n)))
    return let(sha256(text), lambda digest: let(F.transform(places, lambda i: component(digest, i)), unit))


def attempt_id(run: Column, index: Column, binding: Column) -> Column:
    """``<run>-0007-02``."""
    return F.format_string("%s-%04d-%02d", run, index, binding)


def raw_path(kind: Column, at: Column, digest: Column) -> Column:
    """``raw/{kind}/{date}/{hash}.html``."""
    return F.concat_ws("/", F.lit("raw"), kind, F.date_format(at, "yyyy-MM-dd"), F.concat(digest, F.lit(".html")))
