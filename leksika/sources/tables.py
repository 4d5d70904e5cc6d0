"""Scans: schemas, canonical JSON, raw bytes, vectors, catalogs; and the engine's tables derived from the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ENTRY_SCHEMA = """
id STRING, lema STRING, sub_lema ARRAY<STRING>, ejaan STRING, kelas_kata ARRAY<STRING>,
makna ARRAY<STRUCT<definisi:STRING>>, contoh ARRAY<STRING>, turunan ARRAY<STRING>, bentuk_baku STRING,
bentuk_tidak_baku ARRAY<STRING>, pelafalan STRING, pemenggalan STRING, etimologi STRING, labels ARRAY<STRING>, status STRING,
source STRUCT<url:STRING,source_kind:STRING,edition:STRING,source_version:STRING,retrieved_at:TIMESTAMP,content_hash:STRING,parser_version:STRING>,
parser_version STRING, transform_version STRING, review_status STRING, confidence DOUBLE
"""
VECTOR_SCHEMA = """
id STRING, version STRING, doc_id STRING, lema STRING, embedding ARRAY<DOUBLE>, model STRING, dimensions INT, content_hash STRING,
source_kind STRING, edition STRING, source_version STRING, parser_version STRING, embedding_document STRING, created_at TIMESTAMP, metadata MAP<STRING,STRING>
"""
TRANSPORT = "STRUCT<adapter:STRING,path:STRING,content:STRING,base64:STRING,content_type:STRING,expected_raw_hash:STRING,status:INT,retry_after:STRING,max_retries:INT,attempt_sequence:ARRAY<INT>,timeout:BOOLEAN>"
SOURCE_REF = "STRUCT<url:STRING,source_kind:STRING,edition:STRING,source_version:STRING,retrieved_at:STRING,content_hash:STRING,parser_version:STRING>"
CATALOG_SCHEMA = f"""
catalog_id STRING, corpus_version STRING, entries ARRAY<STRUCT<stable_key:STRING,source_ref:{SOURCE_REF},transport:{TRANSPORT},
observations:ARRAY<STRUCT<role:STRING,source_ref:{SOURCE_REF},transport:{TRANSPORT}>>>>
"""


def canonical_entries(spark: SparkSession, path: str) -> DataFrame:
    """Entries from JSON files, one object a line or a file; malformed rows are skipped."""
    return spark.read.schema(ENTRY_SCHEMA).option("mode", "DROPMALFORMED").option("multiLine", True).json(path)


def foreign_entries(documents: DataFrame, column: str = "json") -> tuple[DataFrame, DataFrame]:
    """``documents`` with the entry that a JSON column holds, and those that hold none, with the reason.

    A document that can't be read, lacks id, word or senses, or is not an active official entry (P01) is dropped from the first.
    """
    read = documents.withColumn("entry", F.from_json(column, f"{ENTRY_SCHEMA}, _corrupt STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    reason = (
        F.when(F.col("entry").isNull() | F.col("entry._corrupt").isNotNull(), "unreadable").when(blank(F.col("entry.id")), "id").when(blank(F.col("entry.lema")), "lema")
        .when(F.coalesce(F.size("entry.makna"), F.lit(0)) <= 0, "makna").when(~F.coalesce((F.col("entry.status") == "active") & F.col("entry.source.source_kind").startswith("official-"), F.lit(False)), "not_public")
    )
    judged = read.withColumn("reason", reason)
    return judged.where("reason is null").drop("reason"), judged.where("reason is not null").drop("entry")


def release_entries(spark: SparkSession, root: str, release: str) -> DataFrame:
    """A release's canonical entries, else its candidate snapshot."""
    paths = spark._jvm.org.apache.hadoop.fs.Path
    for folder in (f"{root}/canonical/{release}", f"{root}/candidate_snapshots/{release}"):
        path = paths(folder)
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            return canonical_entries(spark, folder)
    return spark.createDataFrame([], ENTRY_SCHEMA)


def release_vectors(spark: SparkSession, path: str, version: str) -> DataFrame:
    """The vectors of one release; a table partitioned by version is pruned to it."""
    return spark.read.parquet(path).where(F.col("version") == version)


def raw_files(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """Path, content, sha256 of every file under ``path``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(path)
    return files.select("path", "content", F.sha2("content", 256).alias("raw_sha256"))


def raw_snapshot(snapshots: DataFrame, snapshot_id: str) -> DataFrame:
    """One snapshot, only if its bytes still have its hash."""
    return snapshots.where((F.col("raw_snapshot_id") == snapshot_id) & (F.sha2("content", 256) == F.col("raw_sha256")))


def catalog(spark: SparkSession, path: str) -> DataFrame:
    """catalog_id, corpus_version and one row for each entry."""
    read = spark.read.schema(CATALOG_SCHEMA).option("multiLine", True).json(path)
    return read.select("catalog_id", "corpus_version", F.explode("entries").alias("e")).select("catalog_id", "corpus_version", "e.*")


def transport_bytes(transport: Column, file_content: Column | None = None) -> Column:
    """Inline text or base64, else the joined file's content."""
    inline = F.coalesce(F.unbase64(transport["base64"]), F.encode(transport["content"], "UTF-8"))
    return inline if file_content is None else F.coalesce(inline, file_content)


def source_ref(url: Column, kind: Column, content: Column, edition: str = "VI", parser: str = "0.1.0") -> Column:
    """Provenance stamped on content as it is read."""
    return F.struct(
        url.alias("url"), kind.alias("source_kind"), F.lit(edition).alias("edition"), F.lit(edition).alias("source_version"),
        F.current_timestamp().alias("retrieved_at"), F.sha2(content, 256).alias("content_hash"), F.lit(parser).alias("parser_version"),
    )


# The engine's tables as the test tables stand for them.


#: ``^(\S+)`` as RE2 reads it: to Java a vertical tab is white space, too.
FIRST_WORD = r"^([^\t\n\f\r ]+)"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as lexical entries."""
    kind = F.regexp_extract("source", r"^src(\d+)$", 1).try_cast("int") % 5
    tens = F.col("doc_id") % 10
    return read(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("id"), "doc_id",
        F.regexp_extract("text", FIRST_WORD, 1).alias("lema"),
        F.lower(F.regexp_extract("text", FIRST_WORD, 1)).alias("lema_lc"),
        F.col("text").alias("definisi"), F.col("lang").alias("edition"),
        F.when(kind == 0, "official-live").when(kind == 1, "official-snapshot").when(kind == 2, "fallback").when(kind == 3, "gov-derived").otherwise("enrichment").alias("source_kind"),
        F.when(tens == 9, "inactive").when(tens == 8, "unresolved").otherwise("active").alias("status"),
        F.slice(F.split(F.col("text"), " "), 2, 3).alias("variants"),
        "n_chars",
    )


def published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``entries`` with all that a projection needs: word classes, standard forms, lineage."""
    rows = entries(spark, sf_dir).withColumnRenamed("variants", "bentuk_tidak_baku")
    return rows.select(
        "id", "lema", "status", "source_kind", "bentuk_tidak_baku",
        F.when(F.col("doc_id") % 6 == 5, F.get(F.split("definisi", " "), F.lit(5))).alias("bentuk_baku"),
        F.when(F.col("doc_id") % 3 == 0, F.array(F.lit("v"), F.lit("n"))).otherwise(F.array(F.lit("adv"))).alias("kelas_kata"),
        F.concat(F.lit("https://example.org/entri/"), "id").alias("source_url"), F.sha2("definisi", 256).alias("raw_content_hash"),
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``labels`` as review decisions."""
    return read(spark, sf_dir, "labels").select(
        "doc_id", F.when(F.col("toxic") == 1, "quarantined").when(F.col("quality") == 1, "approved").otherwise("rejected").alias("review_status")
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), "label")


#: The same derivations for DuckDB.
ENTRIES_SQL = r"""entries AS (
  SELECT CAST(doc_id AS VARCHAR) AS id, doc_id, regexp_extract(text, '^(\S+)', 1) AS lema, lower(regexp_extract(text, '^(\S+)', 1)) AS lema_lc,
    text AS definisi, lang AS edition,
    CASE TRY_CAST(regexp_extract(source, '^src(\d+)$', 1) AS INTEGER) % 5 WHEN 0 THEN 'official-live' WHEN 1 THEN 'official-snapshot'
      WHEN 2 THEN 'fallback' WHEN 3 THEN 'gov-derived' ELSE 'enrichment' END AS source_kind,
    CASE doc_id % 10 WHEN 9 THEN 'inactive' WHEN 8 THEN 'unresolved' ELSE 'active' END AS status,
    string_split(text, ' ')[2:4] AS variants, n_chars
  FROM documents)"""
PUBLISHED_SQL = """published AS (
  SELECT id, lema, status, source_kind, variants AS bentuk_tidak_baku, CASE WHEN doc_id % 6 = 5 THEN string_split(definisi, ' ')[6] END AS bentuk_baku,
    CASE WHEN doc_id % 3 = 0 THEN ['v', 'n'] ELSE ['adv'] END AS kelas_kata, 'https://example.org/entri/' || id AS source_url, sha256(definisi) AS raw_content_hash,
  FROM entries),
hashed AS (SELECT *, sha256(CAST(to_json({bentuk_baku: bentuk_baku, bentuk_tidak_baku: bentuk_tidak_baku, id: id, kelas_kata: kelas_kata, lema: lema, status: status}) AS VARCHAR) || chr(10)) AS canonical_content_hash FROM published)"""
REVIEWS_SQL = """reviews AS (
  SELECT doc_id, CASE WHEN toxic = 1 THEN 'quarantined' WHEN quality = 1 THEN 'approved' ELSE 'rejected' END AS review_status FROM labels)"""
