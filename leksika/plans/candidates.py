"""Queries over the candidate chain and the documents of runs: ``documents`` as the outcomes of runs of up to 100 keys.

Every side is built as a run would write it, sound. Each slot of ``doc_id`` (or of a run's number) then has one thing changed,
in one table, and so the reason of one broken link.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leksika.functions.hashing import canonical_json, sha256
from leksika.operators import candidates as K
from leksika.plans.registry import Registry
from leksika.session import written
from leksika.sources import tables as T

query = Registry()

PINS = {"parser_version": "0.1.0", "transform_version": "0.2.0", "validation_policy": "strict"}
#: reason, table, column, what it becomes (an expression, or struct, field and expression); a column of None takes the row away, "twice" doubles it. The slot is the place here.
CHANGES = [
    ("run_id_mismatch", "outcome", "attempt_run_id", "'other'"), ("catalog_fingerprint_mismatch", "outcome", "catalog_fingerprint", "'other'"), ("run_fingerprint_mismatch", "outcome", "run_fingerprint", "'other'"),
    ("run_pins_missing", "outcome", "pins", ("pins", "parser_version", "' '")), ("parser_pin_mismatch", "outcome", "pins", ("pins", "parser_version", "'other'")),
    ("transform_pin_mismatch", "outcome", "pins", ("pins", "transform_version", "'other'")), ("validation_policy_mismatch", "outcome", "pins", ("pins", "validation_policy", "'other'")),
    ("candidate_state_mismatch", "outcome", "candidate_member", "true"), ("review_required", "outcome", "review_status", "'pending'"), ("report_outcome_mismatch", "report", "entry_id", "'other'"),
    ("report_outcome_mismatch", "report", "twice", "'other'"), ("quarantined", "outcome", "outcome", "'quarantined'"), ("review_required", "review", "review_status", "'pending'"), ("source_ref_missing", "outcome", "source_ref", "null"),
    ("official_required", "base", "source_ref", ("source_ref", "source_kind", "'fallback'")), ("official_role_mismatch", "outcome", "authority_role", "'evidence'"), ("parser_pin_mismatch", "base", "source_ref", ("source_ref", "parser_version", "'other'")),
    ("accepted_join_missing", "accepted", None, "'other'"), ("accepted_join_mismatch", "accepted", "raw_content_hash", "'other'"), ("accepted_join_mismatch", "accepted", "official", ("official", "run_id", "'other'")),
    ("observation_attempt_missing", "logical", None, "'other'"), ("observation_attempt_mismatch", "logical", "run_fingerprint", "'other'"), ("run_pins_missing", "logical", "pins", "null"), ("observation_attempt_missing", "logical", "source_attempts", "array('other')"),
    ("observation_attempt_mismatch", "logical", "attempt_count", "9"), ("observation_attempt_missing", "attempt", None, "'other'"), ("observation_attempt_missing", "attempt", "twice", "'other'"), ("observation_attempt_mismatch", "attempt", "raw_reference", "'other'"),
    ("validation_policy_mismatch", "attempt", "pins", ("pins", "validation_policy", "'other'")), ("observation_attempt_mismatch", "attempt", "observation", ("observation", "role", "'evidence'")),
    ("parsed_join_outside_run", "base", "parsed_reference", "concat('runs/', run_id, '/../x')"), ("parsed_join_missing", "parsed", None, "'other'"), ("parsed_stable_key_mismatch", "parsed", "stable_key", "'other'"),
    ("canonical_join_mismatch", "parsed", "canonical_reference", "'other'"), ("canonical_hash_mismatch", "parsed", "canonical_content_hash", "'other'"), ("run_fingerprint_mismatch", "parsed", "catalog_fingerprint", "'other'"),
    ("canonical_serialization_mismatch", "parsed", "serialization", "'other'"), ("parsed_lineage_missing", "parsed", "lineage", "null"), ("raw_join_mismatch", "parsed", "lineage", ("lineage", "raw_reference", "'other'")),
    ("parsed_source_join_mismatch", "parsed", "lineage", ("lineage", "source_ref.url", "'x'")), ("official_role_mismatch", "parsed", "lineage", ("lineage", "source_role", "'other'")),
    ("transform_pin_mismatch", "parsed", "lineage", ("lineage", "pins.transform_version", "'x'")), ("parsed_entry_missing", "parsed", "entry", "null"),
    ("parsed_entry_schema_mismatch", "parsed", "entry", "'{\"id\":\"1\"}'"), ("canonical_hash_mismatch", "parsed", "entry", "replace(entry, 'active', 'inactive')"),
    ("canonical_join_missing", "canonical", None, "'other'"), ("canonical_hash_mismatch", "canonical", "content", "encode('other', 'UTF-8')"), ("raw_snapshot_missing", "raw", None, "'other'"), ("raw_hash_mismatch", "raw", "content", "encode('other', 'UTF-8')"),
    ("raw_source_join_mismatch", "base", "source_ref", ("source_ref", "content_hash", "repeat('0', 64)")), ("raw_join_missing", "copy", None, "'other'"), ("raw_hash_mismatch", "copy", "content", "encode('other', 'UTF-8')"),
    ("raw_snapshot_identity_mismatch", "base", "raw_snapshot_id", "concat('raw-x', doc_id)"), ("observation_missing", "observation", None, "'other'"), ("observation_not_immutable", "observation", "immutable", "false"),
    ("observation_source_missing", "observation", "source_ref", "null"), ("observation_source_join_mismatch", "observation", "source_ref", ("source_ref", "url", "'other'")), ("observation_raw_join_mismatch", "observation", "raw_sha256", "'other'"),
    ("observation_role_mismatch", "observation", "role", "'other'"), ("observation_raw_join_mismatch", "observation", "raw_reference", "'other'"), ("parsed_raw_join_mismatch", "copy", "reparsed", "'other'"),
    ("review_source_missing", "review", "official", "null"), ("review_source_join_mismatch", "review", "official", ("official", "canonical_reference", "'other'")),
]
#: Slots whose outcome is a settled conflict: those that a changed review concerns, and two sound ones.
SETTLED = [k for k, (_, table, _, _) in enumerate(CHANGES) if table == "review"][1:] + [len(CHANGES), len(CHANGES) + 1]
SLOTS = len(CHANGES) + 20


def altered(rows: DataFrame, table: str) -> DataFrame:
    """``rows`` (slot and others) with what the slots of ``table`` have changed."""
    values: dict[str, Column] = {}
    for k, (_, of, column, value) in enumerate(CHANGES):
        if of != table:
            continue
        if column is None:
            rows = rows.where(F.col("slot") != k)
        elif column == "twice":
            rows = rows.unionByName(rows.where(F.col("slot") == k))
        else:
            becomes = F.expr(value) if isinstance(value, str) else F.col(value[0]).withField(value[1], F.expr(value[2]))
            values[column] = F.when(F.col("slot") == k, becomes).otherwise(values.get(column, F.col(column)))
    return rows.withColumns(values)


def outcomes_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as outcomes, with their content, entry and slot."""
    run = F.floor(F.col("doc_id") / 100)
    docs = T.read(spark, sf_dir, "documents").select("doc_id", (F.col("doc_id") % SLOTS).cast("int").alias("slot"), F.encode(F.concat_ws("\n", "doc_id", F.coalesce("text", F.lit(""))), "UTF-8").alias("content"))
    base = docs.select(
        "*", F.concat(F.lit("run-"), run.cast("string")).alias("run_id"), F.concat(F.lit("k"), F.lpad(F.col("doc_id").cast("string"), 12, "0")).alias("stable_key"), sha256(F.col("content")).alias("raw_hash"),
        F.struct(*[F.lit(v).alias(k) for k, v in PINS.items()]).alias("pins"),
    )
    base = base.withColumns({
        "run_fingerprint": sha256(F.concat(F.lit("run|"), "run_id")), "catalog_fingerprint": sha256(F.lit("catalog")), "raw_snapshot_id": F.concat(F.lit("raw-"), "raw_hash"), "entry_id": F.col("doc_id").cast("string"),
        "source_ref": F.struct(
            F.col("raw_hash").alias("content_hash"), F.lit("VI").alias("edition"), F.lit(PINS["parser_version"]).alias("parser_version"), F.lit("2024-01-01T00:00:00Z").alias("retrieved_at"), F.lit("official-live").alias("source_kind"),
            F.lit("VI").alias("source_version"), F.concat(F.lit("https://example.org/"), "stable_key").alias("url"),
        ),
        "parsed_reference": F.concat(F.lit("runs/"), "run_id", F.lit("/parsed/"), "stable_key"), "canonical_reference": F.concat(F.lit("runs/"), "run_id", F.lit("/canonical/"), "stable_key"), "raw_reference": F.concat(F.lit("runs/"), "run_id", F.lit("/raw/"), "stable_key"),
        "attempt_id": F.concat(F.lit("attempt-"), "stable_key"), "source_role": F.lit("official"), "authority_role": F.lit("official"),
    })
    base = altered(base, "base")
    base = base.withColumn("observation_id", F.concat(F.lit("observation-"), F.substring(K.observation_hash(F.struct(F.col("raw_hash").alias("raw_sha256"), F.col("raw_snapshot_id"), F.col("source_role").alias("role"), F.col("source_ref"))), 1, 32)))
    base = base.withColumn("entry", entry_of(F.col("content"), F.col("entry_id"), F.col("source_ref"))).withColumn("canonical_content_hash", sha256(F.concat("entry", F.lit("\n"))))
    settled = F.col("slot").isin(*SETTLED)
    return base.withColumns({
        "attempt_run_id": F.col("run_id"), "current": F.lit(True), "candidate_member": F.lit(False), "outcome": F.when(settled, "conflict").otherwise("accepted"), "eligible": F.lit(True), "review_status": F.lit("approved"),
        "release_blocking": F.lit(False), "exclusion_reason": F.lit(None).cast("string"), "attempt_count": F.lit(1), "physical_attempt_count": F.lit(1), "official": K.expected_official(), "review_id": F.concat(F.lit("review-"), "stable_key"),
    })


def entry_of(content: Column, entry_id: Column, source: Column) -> Column:
    """What a parser makes of a document: the canonical JSON of its record."""
    none, text = F.array().cast("array<string>"), F.decode(content, "UTF-8")
    lists = {n: none for n in ("bentuk_tidak_baku", "contoh", "kelas_kata", "labels", "turunan")}
    texts = {n: F.lit(None).cast("string") for n in ("bentuk_baku", "ejaan", "etimologi", "pelafalan", "pemenggalan", "sub_lema")}
    more = {"id": entry_id, "lema": F.regexp_extract(text, r"^(\S*)", 1), "makna": F.array(F.substring(text, 1, 200)), "source": source, "parser_version": F.lit(PINS["parser_version"]), "transform_version": F.lit(PINS["transform_version"])}
    return canonical_json({**lists, **texts, **more, "confidence": F.lit("high"), "status": F.lit("active"), "review_status": F.lit("approved")})


def chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    sound = written(outcomes_of(spark, sf_dir), "outcomes")
    columns = [c.name for c in spark.createDataFrame([], K.OUTCOME).schema]
    rows = altered(sound, "outcome")
    official = F.lit("official")
    nested = F.struct("observation_id", "raw_snapshot_id", F.col("raw_hash").alias("raw_sha256"), "source_ref", official.alias("role"))
    same = {"source_key": F.col("stable_key"), "raw_content_hash": F.col("raw_hash"), "canonical_hash": F.col("canonical_content_hash"), "raw_sha256": F.col("raw_hash"), "source_kind": F.col("source_ref.source_kind")}
    lineage = F.struct(*[same.get(n, F.col(n)).alias(n) for n in K.LINEAGE], "pins")
    parsed = sound.select("slot", "parsed_reference", "run_id", "stable_key", "canonical_reference", "canonical_content_hash", "catalog_fingerprint", "run_fingerprint", "pins", F.lit(K.SERIALIZATION).alias("serialization"), lineage.alias("lineage"), "entry")
    observed = sound.select("slot", "observation_id", F.lit(True).alias("immutable"), F.col("source_role").alias("role"), "source_ref", "raw_snapshot_id", F.col("raw_hash").alias("raw_sha256"), F.col("raw_hash").alias("raw_content_hash"), F.format_string(K.SNAPSHOT_FILE.replace("{}", "%s"), "raw_hash").alias("raw_reference"))
    sides = K.haves(
        altered(rows.select("slot", *columns), "report").drop("slot"), altered(sound.select("slot", *[same.get(c, F.col(c)).alias(c) for c in K.ACCEPTED]), "accepted").drop("slot"),
        altered(sound.select("slot", "run_id", "stable_key", "run_fingerprint", "pins", "attempt_count", "physical_attempt_count", F.array("attempt_id").alias("source_attempts")), "logical").drop("slot"),
        altered(sound.select("slot", *[same.get(c, F.col(c)).alias(c) if c != "outcome" else F.lit("accepted").alias(c) for c in K.ATTEMPT], "attempt_id", "pins", nested.alias("observation")), "attempt").drop("slot"),
        altered(parsed, "parsed").drop("slot"), altered(sound.select("slot", "canonical_reference", F.encode(F.concat("entry", F.lit("\n")), "UTF-8").alias("content")), "canonical").drop("slot"),
        altered(sound.select("slot", "raw_snapshot_id", "content"), "raw").drop("slot"), altered(sound.select("slot", "raw_reference", "content", F.col("entry").alias("reparsed")), "copy").drop("slot"), altered(observed, "observation").drop("slot"),
    )
    reviews = sound.where(F.col("slot").isin(*SETTLED, 12)).select(
        "slot", "run_id", "stable_key", "review_id", F.lit("lexical_conflict").alias("type"), F.lit("approved").alias("review_status"), F.lit("official").alias("selected_authority"), F.lit(False).alias("release_blocking"),
        F.struct(*[same.get(n, F.col(n)).alias(n) for n in K.REVIEWED]).alias("official"),
    )
    runs = sound.select("run_id", "run_fingerprint", "catalog_fingerprint", "pins", F.col("catalog_fingerprint").alias("report_catalog"), F.lit(None).cast("string").alias("state_reason")).distinct()
    drift = F.when(F.col("run_id").endswith("7"), "checkpoint_state_mismatch")
    return K.candidates(rows.select(*columns), runs.withColumn("state_reason", drift), sides, altered(reviews, "review").drop("slot"))


@query(f"""SELECT CASE WHEN (doc_id // 100) % 10 = 7 THEN 'checkpoint_state_mismatch' ELSE CASE doc_id % {SLOTS} {" ".join(f"WHEN {k} THEN '{reason}'" for k, (reason, *_) in enumerate(CHANGES))} ELSE 'member' END END AS reason, count(*) AS n FROM documents GROUP BY 1""")
def q_candidate_chain(spark, sf_dir):
    """Outcomes by the reason of their first broken link."""
    return chain(spark, sf_dir).groupBy(F.coalesce("reason", F.lit("member")).alias("reason")).agg(F.count("*").alias("n"))


@query(f"""SELECT CAST(doc_id AS VARCHAR) AS entry_id, 'run-' || CAST(doc_id // 100 AS VARCHAR) AS run_id, sha256(CAST(doc_id AS VARCHAR) || chr(10) || coalesce(text, '')) AS raw_sha256, 'raw-' || sha256(CAST(doc_id AS VARCHAR) || chr(10) || coalesce(text, '')) AS raw_snapshot_id
FROM documents WHERE doc_id % {SLOTS} >= {len(CHANGES)} AND (doc_id // 100) % 10 <> 7""")
def q_candidate_payload(spark, sf_dir):
    """What a candidate takes over of its members."""
    return K.payload(chain(spark, sf_dir)).select("entry_id", "run_id", "raw_sha256", "raw_snapshot_id")


#: reason, document, field, what it becomes (None: the document is lost).
DRIFTS = [
    ("run_fingerprint_missing", "preflight", None, ""), ("run_id_mismatch", "request", "run_id", "other"), ("run_fingerprint_mismatch", "request", "preflight_hash", "other"), ("run_fingerprint_missing", "preflight", "run", "short"),
    ("catalog_fingerprint_missing", "preflight", "catalog", "short"), ("run_fingerprint_mismatch", "preflight", "run_preimage", "{}"), ("run_fingerprint_mismatch", "request", "idempotency_preimage", "{}"), ("run_id_mismatch", "checkpoint", None, ""),
    ("run_id_mismatch", "outcomes", "run_id", "other"), ("run_fingerprint_mismatch", "attempts", "run", "other"), ("run_fingerprint_mismatch", "status", "catalog", "other"), ("checkpoint_state_mismatch", "checkpoint", "revision", "9"),
    ("checkpoint_state_mismatch", "status", "status", "running"), ("checkpoint_state_mismatch", "outcomes", "outcomes", "101"), ("checkpoint_state_mismatch", "report", "corpus_version", "other"), ("checkpoint_state_mismatch", "attempts", "attempt_count", "0"),
    ("run_pins_missing", "report", "validation_policy", " "), ("transform_pin_mismatch", "outcomes", "transform_version", "other"),
]


def run_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seven documents of each run of ``outcomes_of``, sound but for the drift of its number."""
    keys = T.read(spark, sf_dir, "documents").select(F.floor(F.col("doc_id") / 100).alias("number"), F.concat(F.lit("k"), F.lpad(F.col("doc_id").cast("string"), 12, "0")).alias("key"))
    runs = keys.groupBy("number").agg(F.array_sort(F.collect_list("key")).alias("keys"))  # 100 keys at most
    catalog_preimage = F.to_json(F.struct(F.lit("corpus-1").alias("catalog_id"), F.lit("v1").alias("corpus_version")))
    runs = runs.select("number", F.concat(F.lit("run-"), F.col("number").cast("string")).alias("run_id"), F.to_json("keys").alias("keys"), F.size("keys").cast("string").alias("n"), catalog_preimage.alias("catalog_preimage")).withColumn("catalog", sha256(F.col("catalog_preimage")))
    runs = runs.withColumn("run_preimage", F.to_json(F.struct(F.col("catalog").alias("catalog_fingerprint"), F.lit(100).alias("effective_limit"), *[F.lit(v).alias(k) for k, v in PINS.items()], "run_id"))).withColumn("run", sha256(F.col("run_preimage")))
    text = {n: F.lit(v) for n, v in {"catalog_id": "corpus-1", "corpus_version": "v1", "effective_limit": "100", "revision": "2", "status": "completed", "outcome_counts": "{}", "completion": "{}"}.items()}
    col = {n: F.col(n) for n in ("run_id", "run", "catalog", "run_preimage", "catalog_preimage")}
    n, keys, pins = F.col("n"), F.col("keys"), {k: F.lit(v) for k, v in PINS.items()}
    shared = {k: col[k] for k in ("run_id", "run", "catalog")} | pins | {"revision": text["revision"]}
    shortfall = F.greatest(F.lit(0), 100 - n.cast("int")).cast("string")
    says = {
        "preflight": col | pins | {k: text[k] for k in ("catalog_id", "corpus_version", "effective_limit")} | {"hash": sha256(F.col("run_id")), "selected_keys": keys, "record_keys": keys, "selected_count": n, "shortfall": shortfall},
        "request": {"run_id": col["run_id"], "preflight_hash": sha256(F.col("run_id")), "idempotency_preimage": col["run_preimage"]},
        "checkpoint": shared | {"selected_keys": keys, "processed_count": n, "terminal_count": n, "outcome_counts": text["outcome_counts"]},
        "outcomes": shared | {"outcomes": n, "terminal": n},
        "attempts": shared | {"attempt_count": n, "physical_attempts": n, "logical_attempt_count": n, "logical_attempts": n},
        "status": shared | {"status": text["status"], "outcome_counts": text["outcome_counts"], "completion": text["completion"], "cursor": n},
        "report": shared | {"status": text["status"], "selected_keys": keys, "catalog_id": text["catalog_id"], "corpus_version": text["corpus_version"], "catalog_count": n, "processed_count": n, "completion": text["completion"]},
    }
    slot = F.col("number") % (len(DRIFTS) + 2)

    def value(document: str, name: str, sound: Column) -> Column:
        for k, (_, d, field, becomes) in enumerate(DRIFTS):
            if (d, field) == (document, name):
                sound = F.when(slot == k, becomes).otherwise(sound)
        return sound

    lost = F.lit(False)
    for k, (_, document, field, _) in enumerate(DRIFTS):
        if field is None:
            lost = lost | ((slot == k) & (F.col("d.document") == document))
    maps = [F.struct(F.lit(d).alias("document"), F.map_from_arrays(F.array(*[F.lit(k) for k in v]), F.array(*[value(d, k, c) for k, c in v.items()])).alias("says")) for d, v in says.items()]
    return runs.select("number", "run_id", F.explode(F.array(*maps)).alias("d")).where(~lost).select("run_id", "d.document", "d.says")


@query(f"""SELECT 'run-' || CAST(number AS VARCHAR) AS run_id, coalesce(CASE number % {len(DRIFTS) + 2} {" ".join(f"WHEN {k} THEN '{reason}'" for k, (reason, *_) in enumerate(DRIFTS))} END, 'sound') AS reason, n >= 100 AND number % {len(DRIFTS) + 2} <> 0 AS fixed_checkpoint
FROM (SELECT doc_id // 100 AS number, count(*) AS n FROM documents GROUP BY 1)""")
def q_run_lineage(spark, sf_dir):
    """The drift of each run's documents."""
    return K.run_lineage(run_documents(spark, sf_dir)).select("run_id", F.coalesce("state_reason", F.lit("sound")).alias("reason"), "fixed_checkpoint")
