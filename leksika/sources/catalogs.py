"""Catalogs from JSON: aliases, unknown fields, bindings, and the first reason why an entry isn't valid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leksika.functions.keys import stable_key
from leksika.functions.text import url_host, url_key
from leksika.operators.validation import canonical_writer, first_failure

# Spellings of the fields, of which an entry may use one each, and closed domains.
ENTRY_FIELDS = {"stable_key": ("stable_key", "stableKey", "key"), "source_ref": ("source_ref", "sourceRef", "source"), "transport": ("transport",), "observations": ("observations",)}
SOURCE_FIELDS = {
    "url": ("url",), "source_kind": ("source_kind", "sourceKind"), "edition": ("edition",), "source_version": ("source_version", "sourceVersion"),
    "retrieved_at": ("retrieved_at", "retrievedAt"), "content_hash": ("content_hash", "contentHash"), "parser_version": ("parser_version", "parserVersion"),
}
TRANSPORT_FIELDS = {
    "adapter": ("adapter", "adapter_name"), "status": ("status",), "content_type": ("content_type", "contentType"), "comparison_mode": ("comparison_mode", "comparisonMode"),
    "expected_raw_hash": ("expected_raw_hash", "expectedRawHash", "content_hash"), "path": ("path",), "content": ("content",), "base64": ("base64",),
    "retry_after": ("retry_after", "Retry-After", "retryAfter"), "max_retries": ("max_retries", "maxRetries"), "attempt_sequence": ("attempt_sequence", "attemptSequence"), "timeout": ("timeout",),
}
OFFICIAL_HOSTS, FALLBACK_HOSTS = ("kbbi.kemdikbud.go.id",), ("kbbi.web.id",)
CONTENT_TYPES = ("text/html", "application/json", "text/plain", "application/xhtml+xml")


def field(payload: Column, names: tuple[str, ...]) -> Column:
    return F.coalesce(*[F.get_json_object(payload, f"$['{n}']") for n in names])


def unknown_fields(payload: Column, fields: dict[str, tuple[str, ...]]) -> Column:
    """Keys that no field has."""
    return F.array_except(F.coalesce(F.json_object_keys(payload), F.array().cast("array<string>")), F.array(*[F.lit(n) for names in fields.values() for n in names]))


def ambiguous(payload: Column, fields: dict[str, tuple[str, ...]]) -> Column:
    """Whether a field stands in two spellings."""
    keys = F.coalesce(F.json_object_keys(payload), F.array().cast("array<string>"))
    several = [F.size(F.array_intersect(keys, F.array(*[F.lit(n) for n in names]))) > 1 for names in fields.values() if len(names) > 1]
    found = F.lit(False)
    for s in several:
        found = found | s
    return found


def parsed(payload: Column, fields: dict[str, tuple[str, ...]]) -> Column:
    return F.struct(*[field(payload, names).alias(name) for name, names in fields.items()])


def entries(spark: SparkSession, path: str) -> DataFrame:
    """catalog_id and the JSON of each entry."""
    text = spark.read.text(path, wholetext=True)
    items = F.from_json(F.get_json_object("value", "$.entries"), "array<string>")
    return text.select(F.coalesce(F.get_json_object("value", "$.catalog_id"), F.get_json_object("value", "$.catalogId")).alias("catalog_id"), F.explode(items).alias("payload"))


def observed(observations: Column) -> Column:
    """An entry's further observations as structs that sort by their seven keys: role, url, kind, edition, version, hash, parser."""

    def one(o: Column) -> Column:
        source = parsed(field(o, ENTRY_FIELDS["source_ref"]), SOURCE_FIELDS)
        keys = ("url", "source_kind", "edition", "source_version", "content_hash", "parser_version")
        role = F.coalesce(F.get_json_object(o, "$.role"), F.lit("evidence"))
        return F.struct(role.alias("role"), *[F.coalesce(source[k], F.lit("")).alias(k) for k in keys], o.alias("payload"))

    return F.transform(F.coalesce(F.from_json(observations, "array<string>"), F.array().cast("array<string>")), one)


def records(items: DataFrame, official: tuple[str, ...] = OFFICIAL_HOSTS, fallback: tuple[str, ...] = FALLBACK_HOSTS) -> DataFrame:
    """S07-S10, U-S10: stable_key, source, transport of each entry, and the first reason against it (null if it is valid).

    Sources are HTTPS pages of the hosts named, official kinds of the official ones, and the address ends in the entry's key.
    """
    p = F.col("payload")
    rows = items.withColumn("__k", stable_key(field(p, ENTRY_FIELDS["stable_key"]))).withColumn("__s", field(p, ENTRY_FIELDS["source_ref"])).withColumn("__t", field(p, ENTRY_FIELDS["transport"]))
    rows = rows.withColumn("source", parsed(F.col("__s"), SOURCE_FIELDS)).withColumn("transport", parsed(F.col("__t"), TRANSPORT_FIELDS)).withColumn("stable_key", F.col("__k.key"))
    rows = rows.withColumn("__end", stable_key(url_key(F.col("source.url")))).withColumn("__o", field(p, ENTRY_FIELDS["observations"])).withColumn("__seen", observed(F.col("__o")))
    rows = rows.withColumn("copies", F.when(F.col("stable_key").isNotNull(), F.count("*").over(Window.partitionBy("stable_key"))))
    t, s = F.col("transport"), F.col("source")
    status = F.coalesce(t["status"].try_cast("int"), F.lit(200))
    kind = F.lower(F.trim(F.element_at(F.split(F.coalesce(t["content_type"], F.lit("text/html")), ";"), 1)))
    bound = sum((t[n].isNotNull().cast("int") for n in ("path", "content", "base64")), F.lit(0))
    safe = ~(t["path"].startswith("/") | t["path"].rlike(r"(^|/)\.\.(/|$)") | t["path"].rlike(r"[\x00-\x1f]"))
    digest = "^[0-9a-fA-F]{64}$"
    host, known = url_host(s["url"]), F.lower(s["url"]).startswith("https://")
    identities = F.transform("__seen", lambda o: F.struct(o["source_kind"], o["content_hash"], o["url"]))
    reason = first_failure(
        (F.size(unknown_fields(p, ENTRY_FIELDS)) > 0, "unknown_field"), (ambiguous(p, ENTRY_FIELDS), "ambiguous_alias"),
        (F.col("__k.problem").isNotNull(), "invalid_key"), (F.col("copies") > 1, "key_collision"),
        (F.col("__s").isNull(), "source_missing"), (F.size(unknown_fields(F.col("__s"), SOURCE_FIELDS)) > 0, "unknown_source_field"), (ambiguous(F.col("__s"), SOURCE_FIELDS), "ambiguous_source_alias"),
        (url_key(s["url"]).isNull(), "invalid_url"), (~(known & host.isin(*official, *fallback)), "unapproved_host"),
        (canonical_writer(s["source_kind"]) & ~host.isin(*official), "unofficial_host"), (~F.col("__end.key").eqNullSafe(F.col("stable_key")), "url_mismatch"),
        (~F.coalesce(s["content_hash"].rlike(digest), F.lit(False)), "invalid_source_hash"),
        (F.col("__t").isNull(), "transport_missing"), (F.size(unknown_fields(F.col("__t"), TRANSPORT_FIELDS)) > 0, "unknown_transport_field"), (ambiguous(F.col("__t"), TRANSPORT_FIELDS), "ambiguous_transport_alias"),
        (~F.coalesce(t["adapter"] == "fixture", F.lit(False)), "invalid_adapter"), (t["status"].isNotNull() & ~F.coalesce(status.between(100, 599), F.lit(False)), "invalid_status"),
        ((status < 400) & ~kind.isin(*CONTENT_TYPES), "invalid_content_type"), (~F.coalesce(t["comparison_mode"], F.lit("exact")).isin("exact", "sha256"), "invalid_comparison_mode"),
        ((bound != 1) & ~((bound == 2) & t["path"].isNotNull() & t["content"].isNotNull()), "ambiguous_binding"), (t["path"].isNotNull() & ~safe, "unsafe_path"),
        (t["max_retries"].isNotNull() & ~F.coalesce(t["max_retries"].try_cast("int").between(0, 10), F.lit(False)), "invalid_max_retries"),
        ((status < 400) & ~F.coalesce(t["expected_raw_hash"].rlike(digest), F.lit(False)), "invalid_raw_hash"),
        (F.lower(s["content_hash"]) != F.lower(t["expected_raw_hash"]), "hash_mismatch"),
        (F.col("__o").isNotNull() & ~F.col("__o").rlike(r"^\s*\["), "observations_not_a_list"), (F.size(F.array_distinct(identities)) < F.size(identities), "repeated_observation"),
    )
    return rows.select("catalog_id", "stable_key", "source", "transport", F.col("__o").alias("observations"), reason.alias("reason"))


def bindings(valid: DataFrame) -> DataFrame:
    """The primary binding of each entry, at place 0, and its further observations, one row each, in order of their seven keys."""
    primary = valid.select("stable_key", F.lit("primary").alias("role"), F.lit(0).alias("place"), "source", "transport")
    listed = valid.select("stable_key", F.posexplode(F.array_sort(observed(F.col("observations")))).alias("at", "o"))
    more = listed.select(
        "stable_key", F.col("o.role").alias("role"), (F.col("at") + 1).alias("place"),
        parsed(field(F.col("o.payload"), ENTRY_FIELDS["source_ref"]), SOURCE_FIELDS).alias("source"), parsed(F.get_json_object("o.payload", "$.transport"), TRANSPORT_FIELDS).alias("transport"),
    )
    return primary.unionByName(more)
