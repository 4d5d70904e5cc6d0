"""Published projections."""

from __future__ import annotations

from collections.abc import Callable, Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leksika.functions.hashing import let, record_hash
from leksika.functions.text import strip_space, strip_tags
from leksika.operators.retrieval import OFFICIAL, active_official
from leksika.operators.validation import violations

# The labelled lines of an embedding document, in order, and their separators.
LINES = (("Lema", "lema", None), ("Ejaan", "ejaan", None), ("Kelas Kata", "kelas_kata", ", "), ("Makna", "makna", "; "), ("Contoh", "contoh", " | "), ("Bentuk Tidak Baku", "bentuk_tidak_baku", ", "), ("Pelafalan", "pelafalan", None), ("Etimologi", "etimologi", None), ("Label", "labels", ", "))
# Tracks, the type of a relation, and the fields that relations come from.
TRACKS, RELATION, FIELDS = ("word", "relations"), "nonstandard_variant", ("bentuk_tidak_baku", "bentuk_baku")


def labelled(label: str) -> Callable[[Column], Column]:
    return lambda text: F.when(text != "", F.concat(F.lit(f"{label}: "), text))


def listed(label: str, joint: str, kept: bool) -> Callable[[Column], Column]:
    """The line of a list's cleaned values; a line that is ``kept`` is left out only if all are null."""

    def line(values: Column) -> Column:
        text = F.array_join(F.filter(values, lambda x: x != ""), joint)
        return F.when(F.exists(values, lambda x: x.isNotNull()), F.concat(F.lit(f"{label}: "), text)) if kept else let(text, labelled(label))

    return line


def numbered(kept: bool) -> Callable[[Column, Column], Column]:
    def sense(x: Column, i: Column) -> Column:
        text = F.concat(F.lit("("), (i + 1).cast("string"), F.lit(") "), x)
        return text if kept else F.when(x != "", text)

    return sense


def embedding_document(columns: dict[str, Column], verbatim: Collection[str] = (), kept: Collection[str] = ()) -> Column:
    """Labelled lines in fixed order, without those that are empty; senses keep the numbers they had. Each value is cleaned once.

    Single values named in ``verbatim`` are not cleaned. A list named in ``kept`` has its line, and each of its senses a number,
    even where cleaning leaves nothing of values that aren't null.
    """
    lines = []
    for label, name, joint in LINES:
        if name not in columns:
            continue
        if joint is None:
            lines.append(let(columns[name] if name in verbatim else strip_tags(columns[name]), labelled(label)))
            continue
        values = F.transform(columns[name], strip_tags)
        if name == "makna":
            values = F.transform(values, numbered(name in kept))
        lines.append(let(values, listed(label, joint, name in kept)))
    return F.concat_ws("\n", *lines)


def canonical_hash(entries: DataFrame) -> Column:
    """The hash of an entry's whole record, from the fields it has."""
    return record_hash({c: F.col(c) for c in entries.columns})


def eligible(entries: DataFrame, release: str) -> DataFrame:
    """What may be published: active entries of official sources, with lineage.

    ``entries`` have id, lema, status, source_kind, source_url, raw_content_hash, kelas_kata, bentuk_baku and
    bentuk_tidak_baku; canonical_content_hash is that of the record unless it is given.
    """
    given = "canonical_content_hash" in entries.columns
    hashed = entries if given else entries.withColumn("canonical_content_hash", canonical_hash(entries))
    return hashed.where(active_official()).withColumn("source_release", F.lit(release))


def words(entries: DataFrame, release: str) -> DataFrame:
    """The word track, one record for each eligible entry; lists sorted, rows in order of id where they are written."""
    lists = [F.array_sort(F.coalesce(c, F.array().cast("array<string>"))).alias(c) for c in ("kelas_kata", "bentuk_tidak_baku")]
    return eligible(entries, release).select(
        "id", "lema", F.col("id").alias("source_entry_id"), "canonical_content_hash", "raw_content_hash", "source_url", "source_kind", "source_release", lists[0], "bentuk_baku", lists[1]
    )


def relations(entries: DataFrame, release: str) -> DataFrame:
    """Edges from nonstandard to standard forms: of each variant to its entry's word, and of a word to its standard form.

    Of equal edges that of the lowest entry stays, and of one entry's that of its variants, by partial aggregation.
    """
    rows = eligible(entries, release)
    lineage = (F.col("id").alias("source_entry_id"), F.col("canonical_content_hash").alias("source_hash"))
    of_variants = rows.select(F.explode(F.array_distinct("bentuk_tidak_baku")).alias("from"), F.col("lema").alias("to"), F.lit(FIELDS[0]).alias("canonical_field"), F.lit(0).alias("rank"), *lineage)
    of_words = rows.select(F.col("lema").alias("from"), F.col("bentuk_baku").alias("to"), F.lit(FIELDS[1]).alias("canonical_field"), F.lit(1).alias("rank"), *lineage)
    edges = of_variants.where(strip_space(F.col("from")) != "").unionAll(of_words.where(strip_space(F.col("to")) != ""))
    first = edges.groupBy("from", "to").agg(F.min(F.struct("source_entry_id", "rank", "canonical_field", "source_hash")).alias("e"))
    return first.select("from", "to", F.lit(RELATION).alias("type"), "e.source_entry_id", "e.canonical_field", "e.source_hash", F.lit(release).alias("source_release"))


def status(manifest: Column, artifact: Column, verified: Column) -> Column:
    """Unavailable, pending, validated or failed."""
    return F.when(~manifest & ~artifact, "unavailable").when(~manifest | ~artifact, "pending").when(verified, "validated").otherwise("failed")


def text_failure(name: str) -> tuple[Column, str]:
    return F.col(name).isNull() | (strip_space(F.col(name)) == ""), name


def hash_failure(name: str) -> tuple[Column, str]:
    return ~F.coalesce(F.col(name).rlike("^[0-9a-f]{64}$"), F.lit(False)), name


def word_failures(release: str | None = None) -> Column:
    """The fields for which a word record is not valid."""
    checks = [text_failure(c) for c in ("id", "lema", "source_entry_id")] + [hash_failure(c) for c in ("canonical_content_hash", "raw_content_hash")]
    checks += [text_failure("source_url"), (~F.coalesce(F.col("source_kind").isin(*OFFICIAL), F.lit(False)), "source_kind"), text_failure("source_release"), (~F.col("source_entry_id").eqNullSafe(F.col("id")), "source_entry")]
    if release is not None:
        checks.append((~F.col("source_release").eqNullSafe(release), "release"))
    return violations(*checks)


def relation_failures(release: str | None = None) -> Column:
    """The fields for which a relation record is not valid."""
    checks = [text_failure("from"), text_failure("to"), (~F.col("type").eqNullSafe(RELATION), "type"), text_failure("source_entry_id")]
    checks += [(~F.coalesce(F.col("canonical_field").isin(*FIELDS), F.lit(False)), "canonical_field"), hash_failure("source_hash"), text_failure("source_release")]
    if release is not None:
        checks.append((~F.col("source_release").eqNullSafe(release), "release"))
    return violations(*checks)


def source_entries(words: DataFrame) -> DataFrame:
    """What a projection's manifest lists: entries with their hashes, in order of id."""
    return words.select("source_entry_id", "canonical_content_hash", "raw_content_hash").orderBy("source_entry_id")


def of_track(entries: DataFrame, release: str, track: str) -> DataFrame:
    """The records of a track by its name."""
    return {"word": words, "relations": relations}[track](entries, release)
