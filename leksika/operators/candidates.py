"""Candidates of a release: which outcomes of a run may enter, and why the others may not.

An outcome names its report row, attempts, artifacts, raw bytes and observation. ``candidates`` follows all these links at
once: what an outcome asks for and what each side has are rows of (kind, key), so one join resolves every link of every
outcome, whatever its kind; hashes of bytes and of compared fields are taken before anything moves. The first broken link is
the reason. ``run_lineage`` judges the run itself from its documents, as one pivoted aggregate.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leksika.functions.hashing import hash_valid, sha256
from leksika.operators.retrieval import OFFICIAL
from leksika.operators.validation import first_failure

PINS = "struct<parser_version:string,transform_version:string,validation_policy:string>"
SOURCE = "struct<content_hash:string,edition:string,parser_version:string,retrieved_at:string,source_kind:string,source_version:string,url:string>"
OBSERVED = f"struct<attempt_id:string,run_id:string,source_ref:{SOURCE},source_role:string,raw_snapshot_id:string,observation_id:string,raw_content_hash:string,canonical_content_hash:string>"
OUTCOME = (
    f"run_id string, stable_key string, attempt_run_id string, catalog_fingerprint string, run_fingerprint string, pins {PINS}, current boolean, candidate_member boolean, outcome string, "
    f"eligible boolean, review_status string, release_blocking boolean, exclusion_reason string, source_ref {SOURCE}, source_role string, authority_role string, entry_id string, attempt_id string, "
    f"attempt_count int, physical_attempt_count int, official {OBSERVED}, raw_hash string, raw_snapshot_id string, raw_reference string, observation_id string, parsed_reference string, "
    "canonical_reference string, canonical_content_hash string, review_id string"
)

# Reasons by pin, the serialization of canonical records, where raw snapshots lie, statuses of reviews that block.
PIN_REASONS = {"parser_version": "parser_pin_mismatch", "transform_version": "transform_pin_mismatch", "validation_policy": "validation_policy_mismatch"}
SERIALIZATION = "canonical-record-v1"
SNAPSHOT_FILE = "raw-snapshots/{}.bin"
BLOCKING = ("pending", "quarantined", "rejected")
#: Fields that an accepted join of the report shares with its outcome, beside those of the official observation.
ACCEPTED = ("run_id", "stable_key", "source_key", "entry_id", "run_fingerprint", "catalog_fingerprint", "source_ref", "source_role", "authority_role", "pins", "raw_hash", "raw_content_hash", "canonical_hash", "canonical_content_hash", "raw_snapshot_id", "observation_id", "attempt_id", "canonical_reference", "parsed_reference", "eligible", "candidate_member", "official")
ATTEMPT = ("run_id", "catalog_fingerprint", "run_fingerprint", "stable_key", "source_ref", "source_role", "authority_role", "outcome", "raw_hash", "raw_content_hash", "raw_snapshot_id", "observation_id", "canonical_content_hash", "parsed_reference", "canonical_reference", "raw_reference")
#: Fields of a parsed artifact's lineage, in the order in which they are compared, and what one that differs is called.
LINEAGE = {
    "run_id": "run_id_mismatch", "stable_key": "canonical_hash_mismatch", "attempt_id": "observation_attempt_mismatch", "catalog_fingerprint": "run_fingerprint_mismatch",
    "run_fingerprint": "run_fingerprint_mismatch", "source_ref": "parsed_source_join_mismatch", "source_role": "official_role_mismatch", "authority_role": "official_role_mismatch",
    "raw_hash": "raw_join_mismatch", "raw_content_hash": "raw_join_mismatch", "raw_snapshot_id": "raw_join_mismatch", "observation_id": "observation_attempt_mismatch",
    "raw_reference": "raw_join_mismatch", "canonical_reference": "canonical_join_mismatch", "canonical_content_hash": "canonical_hash_mismatch", "entry_id": "canonical_hash_mismatch",
}
REVIEWED = ("entry_id", "stable_key", "run_id", "catalog_fingerprint", "run_fingerprint", "pins", "source_ref", "source_kind", "source_role", "raw_sha256", "raw_content_hash", "raw_snapshot_id", "observation_id", "parsed_reference", "canonical_reference", "canonical_content_hash")
#: Kinds of links, each with the columns of its key.
KEYS = {
    "report": ("run_id", "stable_key"), "accepted": ("run_id", "stable_key"), "logical": ("run_id", "stable_key"), "source_attempt": ("run_id", "stable_key", "attempt_id"),
    "attempt": ("run_id", "attempt_id"), "parsed": ("parsed_reference",), "canonical": ("canonical_reference",), "raw": ("raw_snapshot_id",), "copy": ("raw_reference",), "observation": ("observation_id",),
}


def text_of(c: Column) -> Column:
    """A value as text that can be compared: JSON for structs, nulls of their fields kept."""
    return F.to_json(F.struct(c.alias("v")), {"ignoreNullFields": "false"})


def fields(rows: Mapping[str, Column]) -> Column:
    return F.map_from_arrays(F.array(*[F.lit(k) for k in rows]), F.array(*[text_of(v) for v in rows.values()]))


def differs(a: Column, b: Column) -> Column:
    return ~a.eqNullSafe(b)


def pins_reasons(actual: Column, expected: Column) -> list[tuple[Column, str]]:
    """Every pin is there and no blank, and is that of the run."""
    missing = F.lit(False)
    for name in PIN_REASONS:
        missing = missing | (F.trim(F.coalesce(actual[name], F.lit(""))) == "")
    return [(missing, "run_pins_missing"), *[(differs(actual[name], expected[name]), reason) for name, reason in PIN_REASONS.items()]]


def annotated(outcomes: DataFrame, run_id: str, layout: str) -> DataFrame:
    """Outcomes with the run and layout that they were written by, current and no member of a candidate yet."""
    return outcomes.withColumns({"attempt_run_id": F.lit(run_id), "layout": F.lit(layout), "current": F.lit(True), "candidate_member": F.lit(False)})


def accepted_joins(outcomes: DataFrame) -> DataFrame:
    """What a run's report says of its accepted outcomes."""
    made = {"source_key": F.col("stable_key"), "raw_content_hash": F.col("raw_hash"), "canonical_hash": F.col("canonical_content_hash")}
    return outcomes.where("outcome = 'accepted'").select(*[made.get(c, F.col(c)).alias(c) for c in ACCEPTED])


def exclusions(outcomes: DataFrame) -> DataFrame:
    """The other outcomes with the reason that the report gives."""
    reason = F.coalesce("exclusion_reason", F.when(F.col("outcome") != "", F.col("outcome")), F.lit("not_eligible"))
    return outcomes.where("not (outcome <=> 'accepted')").select("run_id", "stable_key", "outcome", reason.alias("reason"))


def expected_official() -> Column:
    """The official observation that an outcome has to name."""
    return F.struct("attempt_id", "run_id", "source_ref", F.lit("official").alias("source_role"), "raw_snapshot_id", "observation_id", F.col("raw_hash").alias("raw_content_hash"), "canonical_content_hash")


def expected_values() -> dict[str, Column]:
    """What the fields of an outcome's links have to be."""
    own = {c: F.col(c) for c in (*ACCEPTED, *ATTEMPT, *LINEAGE, *REVIEWED) if c not in ("source_key", "canonical_hash", "raw_content_hash", "raw_sha256", "source_kind", "official", "eligible", "candidate_member")}
    official = F.lit("official")
    return own | {
        "source_key": F.col("stable_key"), "raw_content_hash": F.col("raw_hash"), "raw_sha256": F.col("raw_hash"), "canonical_hash": F.col("canonical_content_hash"), "source_role": official, "authority_role": official,
        "source_kind": F.col("source_ref.source_kind"), "official": expected_official(), "eligible": F.lit(True), "candidate_member": F.lit(False), "outcome": F.lit("accepted"),
    }


def digest(values: Mapping[str, Column], names: tuple[str, ...]) -> Column:
    return sha256(F.concat_ws("\n", *[text_of(values[n]) for n in names]))


def own(names: tuple[str, ...]) -> dict[str, Column]:
    return {n: F.col(n) for n in names}


def haves(report: DataFrame, accepted: DataFrame, logical: DataFrame, attempts: DataFrame, parsed: DataFrame, canonical: DataFrame, raws: DataFrame, copies: DataFrame, observations: DataFrame) -> DataFrame:
    """kind, key, n, fields of all sides: one narrow table.

    ``report`` has the columns of ``OUTCOME``, ``accepted`` those of ``ACCEPTED``; ``logical`` (run_id, stable_key, run_fingerprint, pins, attempt_count, physical_attempt_count,
    source_attempts: ids), ``attempts`` (attempt_id, ``ATTEMPT``, pins, observation), ``parsed`` (parsed_reference, run_id, stable_key, references, hashes, pins, serialization,
    lineage, entry: JSON), ``canonical`` (canonical_reference, content), ``raws`` (raw_snapshot_id, content), ``copies`` (raw_reference, content, reparsed: the JSON of the entry
    that parsing them again gives) and ``observations`` (observation_id and its record).
    """
    pins = {f"pin_{p}": F.col(f"pins.{p}") for p in PIN_REASONS}
    entry = lambda path: F.get_json_object("entry", f"$.{path}")
    names = F.array_join(F.array_sort(F.json_object_keys("entry")), ",")
    sides = {
        "report": (report, {"digest": digest(own(tuple(report.columns)), tuple(sorted(report.columns)))}),
        "accepted": (accepted, {"digest": digest(own(ACCEPTED), ACCEPTED)}),
        "logical": (logical, {"run_fingerprint": F.col("run_fingerprint"), "attempt_count": F.col("attempt_count"), "physical_attempt_count": F.col("physical_attempt_count"), **pins}),
        "source_attempt": (logical.select("run_id", "stable_key", F.explode("source_attempts").alias("attempt_id")), {"is": F.lit(True)}),
        "attempt": (attempts, {"digest": digest(own(ATTEMPT), ATTEMPT), "kind": F.col("source_ref.source_kind"), "nested": F.col("observation"), **pins}),
        "parsed": (
            parsed,
            {
                **own(("run_id", "stable_key", "canonical_reference", "canonical_content_hash", "catalog_fingerprint", "run_fingerprint", "serialization")), **pins,
                "lineage": F.col("lineage").isNotNull(), **{f"lineage_{n}": F.col(f"lineage.{n}") for n in LINEAGE}, **{f"lineage_pin_{p}": F.col(f"lineage.pins.{p}") for p in PIN_REASONS},
                "entry": F.col("entry").isNotNull(), "entry_fields": names, "entry_id": entry("id"), "entry_hash": sha256(F.concat("entry", F.lit("\n"))), "entry_parser": entry("parser_version"),
                "entry_transform": entry("transform_version"), "entry_source": F.from_json(entry("source"), SOURCE),
            },
        ),
        "canonical": (canonical, {"hash": sha256(F.col("content")), "line": F.coalesce(F.substring(F.hex("content"), -2, 2) == "0A", F.lit(False))}),
        "raw": (raws, {"hash": sha256(F.col("content"))}),
        "copy": (copies, {"hash": sha256(F.col("content")), "reparsed": sha256(F.concat("reparsed", F.lit("\n")))}),
        "observation": (observations, {"immutable": F.col("immutable"), "role": F.col("role"), "source_ref": F.col("source_ref"), **own(("observation_id", "raw_snapshot_id", "raw_sha256", "raw_content_hash", "raw_reference"))}),
    }
    narrow = [rows.select(F.lit(kind).alias("kind"), text_of(F.struct(*KEYS[kind])).alias("key"), fields(values).alias("fields")) for kind, (rows, values) in sides.items()]
    out = narrow[0]
    for more in narrow[1:]:
        out = out.unionAll(more)
    return out.groupBy("kind", "key").agg(F.count("*").alias("n"), F.any_value("fields").alias("fields"))


def with_links(outcomes: DataFrame, sides: DataFrame) -> DataFrame:
    """Outcomes with a column (n, fields) for each kind of link, null where there is nothing."""
    asks = F.array(*[F.struct(F.lit(kind).alias("kind"), text_of(F.struct(*key)).alias("key"), F.forall(F.array(*key), lambda x: x.isNotNull()).alias("named")) for kind, key in KEYS.items()])
    asked = outcomes.select("run_id", "stable_key", F.explode(asks).alias("ask")).where("ask.named").select("run_id", "stable_key", "ask.kind", "ask.key")
    met = asked.join(sides, ["kind", "key"]).groupBy("run_id", "stable_key").agg(*[F.any_value(F.when(F.col("kind") == kind, F.struct("n", "fields")), True).alias(f"l_{kind}") for kind in KEYS])
    return outcomes.join(met, ["run_id", "stable_key"], "left")


def judged_reviews(reviews: DataFrame) -> DataFrame:
    """Of each outcome's reviews (run_id, stable_key, review_id, type, review_status, selected_authority, release_blocking, official) the one that settles its conflict for the official side, and whether another blocks."""
    settles = (F.col("type") == "lexical_conflict") & (F.col("review_status") == "approved") & (F.col("selected_authority") == "official")
    blocks = F.coalesce("release_blocking", F.lit(False)) | F.coalesce(F.col("review_status").isin(*BLOCKING), F.lit(False))
    first = F.min(F.when(settles, F.struct("review_id", "release_blocking")))
    return reviews.groupBy("run_id", "stable_key").agg(
        F.min_by(F.when(settles, F.struct("official", "selected_authority")), F.when(settles, F.col("review_id"))).alias("settled"),
        (F.count_if(blocks) > F.when(F.coalesce(first["release_blocking"], F.lit(False)), 1).otherwise(0)).alias("blocked"),
    )


def candidates(outcomes: DataFrame, runs: DataFrame, sides: DataFrame, reviews: DataFrame) -> DataFrame:
    """Every outcome (``OUTCOME``) with ``member`` and the reason of its first broken link.

    ``runs``: run_id, run_fingerprint, catalog_fingerprint, pins, report_catalog, state_reason (of ``run_lineage``).
    ``sides``: what ``haves`` made of the artifacts. ``reviews``: as ``judged_reviews`` takes them.
    """
    run = runs.select("run_id", F.struct("run_fingerprint", "catalog_fingerprint", "pins", "report_catalog", "state_reason").alias("run"))
    rows = with_links(outcomes, sides).join(judged_reviews(reviews), ["run_id", "stable_key"], "left").join(run, "run_id", "left")
    return rows.withColumn("reason", reason_of(outcomes.columns)).select(*outcomes.columns, F.col("reason").isNull().alias("member"), "reason")


def reason_of(columns: list[str]) -> Column:
    """The first broken link of an outcome with its links."""
    want, run, pins = expected_values(), F.col("run"), F.col("run.pins")
    has = lambda kind, name: F.element_at(F.col(f"l_{kind}.fields"), name)
    is_not = lambda kind, name, value: differs(has(kind, name), text_of(value))
    found = lambda kind: F.coalesce(F.col(f"l_{kind}.n"), F.lit(0))
    blank = lambda name: F.coalesce(F.col(name), F.lit("")) == ""
    inside = lambda name: F.col(name).startswith(F.concat(F.lit("runs/"), F.col("run_id"), F.lit("/"))) & ~F.concat(F.lit("/"), F.col(name), F.lit("/")).contains("/../")
    official = F.lit("official")
    missing_pins = lambda kind, prefix: F.exists(F.array(*[F.coalesce(F.trim(F.get_json_object(has(kind, f"{prefix}{p}"), "$.v")), F.lit("")) for p in PIN_REASONS]), lambda x: x == "")
    link_pins = lambda kind, prefix: [(missing_pins(kind, prefix), "run_pins_missing"), *[(is_not(kind, f"{prefix}{p}", pins[p]), r) for p, r in PIN_REASONS.items()]]
    accepted, settled = F.col("outcome").eqNullSafe("accepted"), F.col("settled").isNotNull()
    nested = F.struct("observation_id", "raw_snapshot_id", F.col("raw_hash").alias("raw_sha256"), "source_ref", official.alias("role"))
    lacks_source = F.col("source_ref").isNull() | F.exists(F.array("source_ref.url", "source_ref.source_kind", "source_ref.content_hash", "source_ref.parser_version", "source_ref.retrieved_at"), lambda x: x.isNull())
    preimage = F.struct(F.col("raw_hash").alias("raw_sha256"), F.col("raw_snapshot_id"), F.col("source_role").alias("role"), F.col("source_ref"))
    identity = F.concat(F.lit("observation-"), F.substring(observation_hash(preimage), 1, 32))
    header = [
        (run.isNull(), "run_id_mismatch"), (run["state_reason"].isNotNull(), run["state_reason"]), (blank("stable_key"), "stable_key_missing"), (differs(F.col("attempt_run_id"), F.col("run_id")), "run_id_mismatch"),
        (differs(F.col("catalog_fingerprint"), run["report_catalog"]), "catalog_fingerprint_mismatch"), (differs(F.col("run_fingerprint"), run["run_fingerprint"]), "run_fingerprint_mismatch"), *pins_reasons(F.col("pins"), pins),
        (differs(F.col("current"), F.lit(True)) | differs(F.col("candidate_member"), F.lit(False)), "candidate_state_mismatch"),
        (accepted & (differs(F.col("eligible"), F.lit(True)) | differs(F.col("review_status"), F.lit("approved")) | differs(F.col("release_blocking"), F.lit(False))), "review_required"),
        ((found("report") != 1) | is_not("report", "digest", digest(own(tuple(columns)), tuple(sorted(columns)))), "report_outcome_mismatch"),
        (~accepted & ~settled, F.coalesce("exclusion_reason", F.when(~blank("outcome"), F.col("outcome")), F.lit("not_eligible"))), (F.coalesce("blocked", F.lit(False)), "review_required"), (lacks_source, "source_ref_missing"),
        (~F.coalesce(F.col("source_ref.source_kind").isin(*OFFICIAL), F.lit(False)), "official_required"), (differs(F.col("source_role"), official) | differs(F.col("authority_role"), official), "official_role_mismatch"),
        (differs(F.col("source_ref.parser_version"), pins["parser_version"]), "parser_pin_mismatch"),
        (accepted & (found("accepted") != 1), "accepted_join_missing"), (accepted & is_not("accepted", "digest", digest(want, ACCEPTED)), "accepted_join_mismatch"),
    ]
    attempt = [
        (F.col("official").isNull() | blank("attempt_id"), "observation_attempt_missing"), (differs(text_of(F.col("official")), text_of(expected_official())), "observation_attempt_mismatch"),
        (found("logical") != 1, "observation_attempt_missing"), (is_not("logical", "run_fingerprint", run["run_fingerprint"]), "observation_attempt_mismatch"), *link_pins("logical", "pin_"),
        (found("source_attempt") != 1, "observation_attempt_missing"),
        (F.get_json_object(has("logical", "attempt_count"), "$.v").isNotNull() & is_not("logical", "attempt_count", F.col("attempt_count")), "observation_attempt_mismatch"),
        (F.get_json_object(has("logical", "physical_attempt_count"), "$.v").isNotNull() & is_not("logical", "physical_attempt_count", F.coalesce("physical_attempt_count", "attempt_count")), "observation_attempt_mismatch"),
        (found("attempt") != 1, "observation_attempt_missing"), (is_not("attempt", "digest", digest(want, ATTEMPT)), "observation_attempt_mismatch"), *link_pins("attempt", "pin_"),
        (is_not("attempt", "nested", nested), "observation_attempt_mismatch"),
    ]
    parsed = [
        (~hash_valid(F.col("canonical_content_hash")), "canonical_hash_missing"), (blank("parsed_reference"), "parsed_join_missing"), (~inside("parsed_reference"), "parsed_join_outside_run"), (found("parsed") != 1, "parsed_join_missing"),
        (is_not("parsed", "run_id", F.col("run_id")), "run_id_mismatch"), (is_not("parsed", "stable_key", F.col("stable_key")), "parsed_stable_key_mismatch"),
        (is_not("parsed", "canonical_reference", F.col("canonical_reference")), "canonical_join_mismatch"), (is_not("parsed", "canonical_content_hash", F.col("canonical_content_hash")), "canonical_hash_mismatch"),
        (is_not("parsed", "catalog_fingerprint", run["catalog_fingerprint"]) | is_not("parsed", "run_fingerprint", run["run_fingerprint"]), "run_fingerprint_mismatch"), *link_pins("parsed", "pin_"),
        (is_not("parsed", "serialization", F.lit(SERIALIZATION)), "canonical_serialization_mismatch"), (is_not("parsed", "lineage", F.lit(True)), "parsed_lineage_missing"),
        *[(is_not("parsed", f"lineage_{n}", want[n]), reason) for n, reason in LINEAGE.items()], *link_pins("parsed", "lineage_pin_"),
        (is_not("parsed", "entry", F.lit(True)), "parsed_entry_missing"), (is_not("parsed", "entry_fields", F.lit(",".join(sorted(RECORD)))), "parsed_entry_schema_mismatch"),
        (F.coalesce(F.get_json_object(has("parsed", "entry_id"), "$.v"), F.lit("")) == "", "entry_id_missing"), (is_not("parsed", "entry_hash", F.col("canonical_content_hash")), "canonical_hash_mismatch"),
        (F.get_json_object(has("parsed", "entry_source"), "$.v.url").isNull(), "entry_source_missing"), (is_not("parsed", "entry_source", F.col("source_ref")), "entry_source_join_mismatch"),
        (is_not("parsed", "entry_id", F.col("entry_id")), "entry_id_mismatch"), (is_not("parsed", "entry_parser", pins["parser_version"]), "parser_pin_mismatch"), (is_not("parsed", "entry_transform", pins["transform_version"]), "transform_pin_mismatch"),
        (blank("canonical_reference"), "canonical_join_missing"), (~inside("canonical_reference"), "canonical_join_outside_run"), (found("canonical") != 1, "canonical_join_missing"),
        (is_not("canonical", "hash", F.col("canonical_content_hash")), "canonical_hash_mismatch"), (is_not("canonical", "line", F.lit(True)), "canonical_serialization_mismatch"),
    ]
    raw = [
        (~hash_valid(F.col("raw_hash")), "raw_hash_missing"), (blank("raw_snapshot_id") | (found("raw") < 1), "raw_snapshot_missing"), (is_not("raw", "hash", F.col("raw_hash")), "raw_hash_mismatch"),
        (differs(F.col("source_ref.content_hash"), F.col("raw_hash")), "raw_source_join_mismatch"), (blank("raw_reference"), "raw_join_missing"), (~inside("raw_reference"), "raw_join_missing"), (found("copy") != 1, "raw_join_missing"),
        (is_not("copy", "hash", F.col("raw_hash")), "raw_hash_mismatch"),
        (blank("observation_id"), "observation_missing"), (differs(F.col("raw_snapshot_id"), F.concat(F.lit("raw-"), F.col("raw_hash"))), "raw_snapshot_identity_mismatch"), (differs(F.col("observation_id"), identity), "observation_identity_mismatch"),
        (found("observation") < 1, "observation_missing"), (is_not("observation", "immutable", F.lit(True)), "observation_not_immutable"), (F.get_json_object(has("observation", "source_ref"), "$.v.url").isNull(), "observation_source_missing"),
        (is_not("observation", "source_ref", F.col("source_ref")), "observation_source_join_mismatch"),
        *[(is_not("observation", mine, F.col(theirs)), "observation_raw_join_mismatch") for mine, theirs in (("raw_snapshot_id", "raw_snapshot_id"), ("raw_sha256", "raw_hash"), ("raw_content_hash", "raw_hash"))],
        (is_not("observation", "role", F.col("source_role")), "observation_role_mismatch"),
        (is_not("observation", "raw_reference", F.format_string(SNAPSHOT_FILE.replace("{}", "%s"), "raw_hash")), "observation_raw_join_mismatch"), (is_not("copy", "reparsed", F.col("canonical_content_hash")), "parsed_raw_join_mismatch"),
        (settled & F.col("settled.official").isNull(), "review_source_missing"), (settled & differs(digest({n: F.col(f"settled.official.{n}") for n in REVIEWED}, REVIEWED), digest(want, REVIEWED)), "review_source_join_mismatch"),
    ]
    return first_failure(*header, *attempt, *parsed, *raw)


def observation_hash(preimage: Column) -> Column:
    """the hash that an observation's id comes from: its whole preimage, keys sorted."""
    return sha256(F.to_json(F.struct(preimage["raw_sha256"].alias("raw_sha256"), preimage["raw_snapshot_id"].alias("raw_snapshot_id"), preimage["role"].alias("role"), preimage["source_ref"].alias("source_ref")), {"ignoreNullFields": "false"}))


# The fields of a canonical record.
RECORD = (
    "bentuk_baku", "bentuk_tidak_baku", "confidence", "contoh", "ejaan", "etimologi", "id", "kelas_kata", "labels", "lema", "makna", "parser_version", "pelafalan", "pemenggalan", "review_status",
    "source", "status", "sub_lema", "transform_version", "turunan",
)


def payload(members: DataFrame) -> DataFrame:
    """What a candidate takes over of its members: lineage under its names in a release."""
    return members.where("member").select(
        "entry_id", "stable_key", "run_id", "run_fingerprint", "catalog_fingerprint", "pins", "source_ref", F.lit("official").alias("source_role"), F.lit("official").alias("authority_role"), F.col("raw_hash").alias("raw_sha256"),
        F.col("raw_hash").alias("raw_content_hash"), "raw_snapshot_id", "observation_id", "attempt_id", "canonical_content_hash", "canonical_reference", "parsed_reference", "raw_reference", F.lit(SERIALIZATION).alias("canonical_serialization"), "review_id",
    )


#: Documents of a run: what each says, as text by name.
DOCUMENTS = ("preflight", "request", "checkpoint", "outcomes", "attempts", "status", "report")


def run_lineage(documents: DataFrame) -> DataFrame:
    """Each run with its fingerprints, pins and the reason why its documents don't belong together, null if they do.

    ``documents``: run_id, document, says (map of texts: the document's run_id, run and catalog, pins by name, revision,
    status, counts; lists and objects as canonical JSON). One aggregate brings a run's seven documents side by side.
    """
    rows = documents.groupBy("run_id").agg(*[F.any_value(F.when(F.col("document") == d, F.col("says")), True).alias(d) for d in DOCUMENTS])
    say = lambda d, name: F.try_element_at(F.col(d), F.lit(name))
    number = lambda d, name: say(d, name).try_cast("long")
    run, catalog, limit = say("preflight", "run"), say("preflight", "catalog"), number("preflight", "effective_limit")
    preimage = lambda name: F.get_json_object(say("preflight", "run_preimage"), f"$.{name}")
    keys = F.from_json(say("preflight", "selected_keys"), "array<string>")
    records = F.from_json(say("preflight", "record_keys"), "array<string>")
    others = [d for d in DOCUMENTS if d != "preflight"]
    bound = [d for d in others if d != "request"]
    pins_of = lambda d: F.struct(*[say(d, p).alias(p) for p in PIN_REASONS])
    any_of = lambda conditions: F.exists(F.array(*conditions), lambda x: x)
    state = [
        differs(keys, F.slice(records, 1, F.greatest(limit, F.lit(0)).cast("int"))), differs(number("preflight", "selected_count"), F.size(keys).cast("long")),
        differs(number("preflight", "shortfall"), F.greatest(F.lit(0), limit - F.size(records)).cast("long")), limit.isNull(), differs(preimage("effective_limit").try_cast("long"), limit),
        *[differs(say("report", "revision"), say(d, "revision")) for d in ("checkpoint", "outcomes", "attempts", "status")], differs(say("report", "status"), say("status", "status")),
        differs(say("report", "selected_keys"), say("preflight", "selected_keys")), differs(say("checkpoint", "selected_keys"), say("preflight", "selected_keys")), differs(say("report", "catalog_id"), say("preflight", "catalog_id")),
        differs(say("report", "corpus_version"), say("preflight", "corpus_version")), differs(number("report", "catalog_count"), F.size(records).cast("long")), differs(number("checkpoint", "processed_count"), number("outcomes", "outcomes")),
        differs(number("report", "processed_count"), number("outcomes", "outcomes")), differs(number("checkpoint", "terminal_count"), number("outcomes", "terminal")), differs(say("status", "outcome_counts"), say("checkpoint", "outcome_counts")),
        differs(say("status", "completion"), say("report", "completion")), differs(number("attempts", "attempt_count"), number("attempts", "physical_attempts")), differs(number("attempts", "logical_attempt_count"), number("attempts", "logical_attempts")),
        differs(number("status", "cursor"), number("outcomes", "outcomes")),
    ]
    checks = [
        (F.col("preflight").isNull() | (run.isNull() & catalog.isNull()), "run_fingerprint_missing"), (differs(say("request", "run_id"), F.col("run_id")), "run_id_mismatch"), (differs(say("request", "preflight_hash"), say("preflight", "hash")), "run_fingerprint_mismatch"),
        (~hash_valid(run), "run_fingerprint_missing"), (~hash_valid(catalog), "catalog_fingerprint_missing"), (say("preflight", "run_preimage").isNull() | say("preflight", "catalog_preimage").isNull(), "run_fingerprint_unverifiable"),
        (differs(sha256(say("preflight", "run_preimage")), run) | differs(sha256(say("preflight", "catalog_preimage")), catalog) | differs(preimage("catalog_fingerprint"), catalog), "run_fingerprint_mismatch"),
        (any_of([differs(preimage(p), say("preflight", p)) for p in PIN_REASONS]), "run_fingerprint_mismatch"), (differs(say("request", "idempotency_preimage"), say("preflight", "run_preimage")), "run_fingerprint_mismatch"),
        *[(differs(say(d, "run_id"), F.col("run_id")), "run_id_mismatch") for d in bound], *[(differs(say(d, "run"), run) | differs(say(d, "catalog"), catalog), "run_fingerprint_mismatch") for d in bound],
        (any_of(state), "checkpoint_state_mismatch"), *pins_reasons(pins_of("preflight"), pins_of("preflight"))[:1], *[x for d in bound for x in pins_reasons(pins_of(d), pins_of("preflight"))],
    ]
    fixed = (limit == 100) & (F.size(records) >= 100) & (F.size(keys) == 100)
    return rows.select("run_id", run.alias("run_fingerprint"), catalog.alias("catalog_fingerprint"), pins_of("preflight").alias("pins"), say("report", "catalog").alias("report_catalog"), F.coalesce(fixed, F.lit(False)).alias("fixed_checkpoint"), first_failure(*checks).alias("state_reason"))
