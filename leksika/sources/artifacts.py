"""Published projections as artifacts with manifests: one folder for each identity, verified by the bytes that lie there.

``<root>/<consumer>/<track>/<release>/<generator>/<schema>/`` holds ``data/`` (Parquet) and ``manifest.json``. Both are staged
together and taken by one rename, so there is no artifact without its manifest. The manifest has counts, a digest over the
artifact's files (their names, sizes and hashes) and its own hash; a listing computes all of them again in Spark, over all
artifacts at once, and calls verified only what agrees.
"""

from __future__ import annotations

import json
import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leksika.functions.hashing import canonical_json, hash_valid, sha256
from leksika.operators.validation import first_failure, violations
from leksika.sources.sinks import Conflict, exists, locked, remove, take

# Tracks with their schema versions, and the fields of a manifest.
SCHEMAS = {"word": "word-v1", "relations": "relations-v1"}
IDENTITY = ("consumer", "track", "source_release", "generator_version", "schema_version")
COUNTS = ("source_count", "output_count", "files")
MANIFEST = (*IDENTITY, *COUNTS, "source_digest", "output_digest", "manifest_hash")


class Identity(NamedTuple):
    """What names an artifact. A part may be no path."""

    consumer: str
    track: str
    source_release: str
    generator_version: str
    schema_version: str

    def path(self, root: str) -> str:
        for part in self:
            if not part or part in (".", "..") or "/" in part or "\\" in part:
                raise ValueError(f"{part!r} names no artifact")
        if SCHEMAS.get(self.track) != self.schema_version:
            raise ValueError(f"{self.track} has no schema {self.schema_version}")
        return "/".join((root.rstrip("/"), *self))


def files_of(spark: SparkSession, root: str) -> DataFrame:
    """folder, name, size, hash of all data files below a path; bytes are hashed in tasks, a file at a time."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root)
    at = F.regexp_extract("path", r"^(.*)/data/([^/]+)$", 1)
    return found.where(at != "").select(folder_of(at).alias("folder"), F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), F.col("length").alias("size"), sha256(F.col("content")).alias("hash"))


def folder_of(path: Column) -> Column:
    """A path as the five parts of an identity, which end it; staged folders have none."""
    return F.regexp_extract(path, r"((?:/[^/]+){5})$", 1)


def digests_of(files: DataFrame) -> DataFrame:
    """folder, files, digest: over the files of each artifact, as many lines as it has files."""
    line = F.concat_ws(":", "name", F.col("size").cast("string"), "hash")
    return files.groupBy("folder").agg(F.count("*").alias("files"), sha256(F.array_join(F.array_sort(F.collect_list(line)), "\n")).alias("digest"))


def own_hash(values: dict[str, Column]) -> Column:
    """the hash of a manifest without the field that holds it."""
    return sha256(canonical_json({k: v for k, v in values.items() if k != "manifest_hash"}))


def staged_manifest(spark: SparkSession, staging: str, identity: Identity, source_count: int, source_digest: str, output_count: int) -> str:
    """The manifest of a staged artifact as canonical JSON, of a few hundred bytes whatever the artifact's size."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(f"{staging}/data").select(F.lit("").alias("folder"), F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), F.col("length").alias("size"), sha256(F.col("content")).alias("hash"))
    found = digests_of(files).first()
    values = {**identity._asdict(), "source_count": source_count, "output_count": output_count, "files": found.files, "source_digest": source_digest, "output_digest": found.digest}
    columns = {k: F.lit(v).cast("long") if k in COUNTS else F.lit(v) for k, v in values.items()}
    row = spark.range(1).select(canonical_json({**columns, "manifest_hash": own_hash(columns)}).alias("json")).first()
    return row.json


def write_text(spark: SparkSession, path: str, text: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, False)
    try:
        out.write(text.encode())
    finally:
        out.close()


def publish_artifact(rows: DataFrame, root: str, identity: Identity, order: list[str], source_count: int, source_digest: str) -> bool:
    """Data and manifest as one unit; False, and nothing done, if the identity has the same source and rows already.

    The same identity with another source or other rows fails closed: a ``Conflict``, and what is published stays as it
    is, as it does for a writer that loses a race, and for an artifact that no longer is what its manifest says.
    """
    spark, path = rows.sparkSession, identity.path(root)
    staging = f"{root.rstrip('/')}/_staging/{uuid.uuid4().hex}"

    def published() -> bool:
        if not exists(spark, path):
            return False
        there = artifacts(spark, path, identity).first()
        if not there.verified:
            raise Conflict(f"{path}: {there.reason}")
        apart = spark.read.schema(rows.schema).parquet(f"{path}/data").exceptAll(rows).limit(1).count() or there.source_digest != source_digest or there.output_count != rows.count()
        if apart:
            raise Conflict(f"{path} is published with other content")
        return True

    if published():
        return False
    try:
        with locked(spark, path):
            if published():
                return False
            rows.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(f"{staging}/data")
            count = spark.read.schema(rows.schema).parquet(f"{staging}/data").count()
            write_text(spark, f"{staging}/manifest.json", staged_manifest(spark, staging, identity, source_count, source_digest, count))
            take(spark, staging, path)
        there = artifacts(spark, path, identity).first()
        if not there.verified:
            raise ValueError(f"{path}: {there.reason}")
        return True
    finally:
        remove(spark, staging)


def manifest_failures(folder: Column) -> Column:
    """P20: which fields of a manifest are not valid; ``folder`` is where it lies, which has to be its identity."""
    texts = [(F.trim(F.coalesce(F.col(n), F.lit(""))) == "", n) for n in IDENTITY]
    counts = [(F.col(n).isNull() | (F.col(n) < 0), n) for n in COUNTS]
    hashes = [(~hash_valid(F.col(n)), n) for n in ("source_digest", "output_digest", "manifest_hash")]
    schema = F.element_at(F.create_map(*[F.lit(x) for pair in SCHEMAS.items() for x in pair]), F.col("track"))
    same = F.concat(F.lit("/"), F.array_join(F.array(*IDENTITY), "/"))
    return violations(*texts, *counts, *hashes, (~schema.eqNullSafe(F.col("schema_version")), "schema"), (~same.eqNullSafe(folder), "identity"))


def artifacts(spark: SparkSession, root: str, identity: Identity | None = None) -> DataFrame:
    """Every artifact below ``root`` with its manifest, whether its bytes bear it out, and the reason if not.

    One pass over the manifests and one over the data files of all artifacts; a join tells what has no manifest, too.
    """
    fields = ", ".join(f"{n} {'long' if n in COUNTS else 'string'}" for n in MANIFEST)
    read = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "manifest.json").load(root)
    said = read.select(folder_of(F.regexp_extract("path", r"^(.*)/manifest\.json$", 1)).alias("folder"), F.decode("content", "UTF-8").alias("json")).where("folder <> '' and folder not like '%/_staging/%'")
    manifests = said.select("folder", F.from_json("json", fields).alias("m"), "json").select("folder", "json", "m.*")
    own = {n: F.col(n) for n in MANIFEST}
    checked = manifests.withColumn("failures", manifest_failures(F.col("folder"))).withColumn("self", own_hash(own).eqNullSafe(F.col("manifest_hash")) & (canonical_json(own) == F.col("json")))
    bytes_ = digests_of(files_of(spark, root).where("folder not like '%/_staging/%'")).select("folder", F.col("files").alias("has_files"), "digest")
    met = checked.join(bytes_, "folder", "full_outer")
    reason = first_failure(
        (F.col("json").isNull(), "manifest_missing"), (F.size("failures") > 0, F.concat(F.lit("manifest_invalid: "), F.array_join("failures", ","))), (~F.col("self"), "manifest_hash_mismatch"),
        (F.col("digest").isNull() & (F.col("files") > 0), "artifact_missing"), (~F.col("digest").eqNullSafe(F.col("output_digest")) | ~F.col("has_files").eqNullSafe(F.col("files")), "output_hash_mismatch"),
    )
    out = met.select("folder", *MANIFEST, reason.alias("reason")).withColumn("verified", F.col("reason").isNull())
    return out if identity is None else out.where(F.col("folder") == "/" + "/".join(identity))


def read_artifact(spark: SparkSession, root: str, identity: Identity) -> DataFrame:
    """The rows of exactly this artifact, verified as they are asked for; there is no other to fall back to."""
    path = identity.path(root)
    there = artifacts(spark, path, identity).first() if exists(spark, path) else None
    if there is None or not there.verified:
        raise FileNotFoundError(f"{path}: {there.reason if there else 'not published'}")
    return spark.read.parquet(f"{path}/data")


def manifest_of(spark: SparkSession, root: str, identity: Identity) -> dict:
    """An artifact's manifest as it stands."""
    text = spark.read.text(f"{identity.path(root)}/manifest.json", wholetext=True).first()
    return json.loads(text.value)
