"""What several operators share: tables, the shared folder, text batches.

Everything that must outlive a task goes to the folder which the cluster names in
``spark.checkpoint.dir``; nothing is kept in a machine-local folder.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a Python worker works on at once, besides a single longer text, and of the batches that it is sent.
BATCH_BYTES, SENT_BYTES = 4 << 20, 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; one of our own only where that is unset and all tasks are on this machine."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext._jsc.sc()
    if context.getCheckpointDir().isEmpty():
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("on a cluster spark.checkpoint.dir must name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="leksika-"))
    return context.getCheckpointDir().get().rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, under one folder for each application."""
    return f"{shared_dir(spark)}/leksika-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


#: Whether what a finished write had shuffled is removed; Spark's default keeps it as long as the driver remembers the plan.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Spark's default sends batches of 64 MB, of which JVM and worker hold several at a time.
SENT = "spark.sql.execution.arrow.maxBytesPerBatch"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there and a lost executor costs nothing.

    The plan ``df`` has shuffles of its own only, so these are removed once it is written. From here on the session
    sends texts to workers in batches of ``SENT_BYTES``.
    """
    spark = df.sparkSession
    spark.conf.set(SENT, str(SENT_BYTES))
    path = work_path(spark, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    written = spark.read.schema(df.schema).parquet(path)
    written.written_at = path
    return written


def discard(*written: DataFrame) -> None:
    """Delete what ``materialise`` wrote, when all that was made of it is written too."""
    for df in written:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.written_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def dealt(n: int) -> Column:
    """One of ``n`` groups for each row, about equally many rows in each, however rows lie in partitions.

    (Row ids without the hash are multiples of 2^33 plus a place in the partition, and not even where partitions are small.)
    """
    return F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n))


#: A key with more than one in so many rows is joined by broadcast; there are fewer such keys than this.
HOT = 1000


def spread_join(rows: DataFrame, table: DataFrame, key: str, value: str, counted: DataFrame | None = None) -> DataFrame:
    """``rows`` with the ``value`` of ``table``, which has each ``key`` once; null where it hasn't.

    Keys of more than one in ``HOT`` rows, of which there are fewer than ``HOT``, are met by broadcast; the rows of
    these, and those without a key, are dealt to all tasks of the join of the others. ``counted``: what keys are counted in,
    if that is cheaper to come by than ``rows``, which are some of it.
    """
    counted = rows if counted is None else counted
    counts = counted.groupBy(key).count()
    many = counted.count() // HOT
    hot = materialise(table.select(key, value).join(F.broadcast(counts.where((F.col("count") > many) & F.col(key).isNotNull()).select(key)), key), "hot")
    met = rows.join(F.broadcast(hot.withColumnRenamed(value, "__hot").withColumn("__is", F.lit(True))), key, "left")
    alone = F.col(key).isNotNull() & F.col("__is").isNull()
    met = met.withColumn("__key", F.when(alone, F.col(key))).withColumn("__deal", F.when(alone, F.lit(0)).otherwise(1 + dealt(4096)))
    others = table.select(F.col(key).alias("__key"), F.lit(0).cast("long").alias("__deal"), F.col(value).alias("__other"))
    return met.join(others, ["__key", "__deal"], "left").withColumn(value, F.coalesce("__hot", "__other")).drop("__key", "__deal", "__is", "__hot", "__other")


def release(spark: SparkSession) -> None:
    """Delete what this application materialised; call it once the results are written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/leksika-{spark.sparkContext.applicationId}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def remainder(doc_id: Column, by: int) -> Column:
    """crc32 of the id written as text, modulo ``by``; null for a null id."""
    return F.crc32(doc_id.cast("string")) % by


def pieces(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into slices whose texts have about ``limit`` bytes; a longer single text is a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        start = held = 0
        for i, size in enumerate(sizes.tolist()):
            if i > start and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        yield batch.slice(start)
        pa.default_memory_pool().release_unused()


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def among_least(digest: Column, keep: int, total: int) -> Column:
    """Whether a 64-bit hash is among the least four times ``keep`` of ``total`` evenly spread ones.

    A sample of the ``keep`` least hashes then orders a bounded set, however many rows and tasks there are.
    """
    share = 1.0 if total <= 4 * keep else 4.0 * keep / total
    return F.shiftrightunsigned(digest, 33) < int(share * (1 << 31))


def least_share(total: Column, keep: int) -> Column:
    """The same for a ``total`` by row: what the hash's 31 highest bits are to stay below."""
    return F.when(total <= 4 * keep, F.lit(1 << 31)).otherwise((F.lit(4.0 * keep * (1 << 31)) / total).cast("long"))


#: Labelled rows that a classifier learns from at most.
TRAIN_ROWS = 8000


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, fold: Column, max_rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, text, label of at most ``max_rows`` labelled documents, whole texts, written to the shared folder.

    The rows are those of the smallest id hashes where ``fold`` (over the column doc_id) holds. An id with
    several labels takes the largest, one with several texts that of the smallest hash; null labels and null
    ids teach nothing. The ids of the sample are broadcast: ``max_rows`` numbers at most.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & fold)
    digest = F.xxhash64("doc_id")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # Labels of ids that have no document here teach nothing and take no place.
    known = materialise(known.groupBy("doc_id").agg(F.max("label").alias("label")).join(texts.select("doc_id").distinct(), "doc_id", "left_semi"), "labels")
    ids = known.where(among_least(digest, max_rows, known.count())).orderBy(F.shiftrightunsigned(digest, 1), digest, "doc_id").limit(max_rows)
    met = texts.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.first("label").alias("label"))
    return materialise(met, "labelled")


def in_tasks(sample: DataFrame, of_text: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> pa.Table:
    """What ``of_text`` makes of the rows of a sample, in order of doc_id: texts stay where they are, features come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            yield of_text(part)

    return sample.repartition(32, "doc_id").mapInArrow(run, schema).toArrow().sort_by("doc_id").combine_chunks()


def judged(docs: DataFrame, score, fold: Column) -> DataFrame:
    """doc_id, held_out, score, predicted: ``score`` maps an Arrow column of texts to probabilities."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            scores = score(part.column("text"))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = picked.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(fold, F.lit(False)).alias("held_out"), "score", (F.col("score") >= PREDICT_AT).cast("int").alias("predicted"))


#: A score from here on predicts label 1.
PREDICT_AT = 0.3


#: The six bytes of ASCII white space, and A-Z to a-z, whatever the worker's locale.
WHITE = np.isin(np.arange(256), (9, 10, 11, 12, 13, 32))
LOWER = np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), np.arange(256) + 32, np.arange(256)).astype(np.uint8)


class Words:
    """The ASCII-white-space words of a batch of texts, each distinct word once.

    ``codes`` numbers the words of all texts in order, ``ends`` and ``starts`` bound each text in
    ``codes``, and ``distinct`` holds the words as an Arrow binary array. ``inside``: the bytes that words
    are made of, if not all but white space.
    """

    def __init__(self, column: pa.Array, lower: bool = False, inside: np.ndarray = ~WHITE):
        texts = pc.fill_null(column.cast(pa.large_string()), "")
        ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        held = texts.buffers()[2]
        data = (np.frombuffer(held, np.uint8) if held is not None else np.empty(0, np.uint8))[ends[0] : ends[-1]]
        ends = ends - ends[0]
        if lower:
            data = LOWER[data]
        solid = inside[data]
        begins = solid.copy()
        begins[1:] &= ~solid[:-1]
        first = ends[:-1][ends[:-1] < len(data)]
        begins[first] = solid[first]  # a word ends where its text does
        at = np.flatnonzero(begins)
        before = np.cumsum(solid, dtype=np.int32 if len(solid) < 1 << 31 else np.int64)
        offsets = np.append(before[at].astype(np.int64) - 1, solid.sum())
        del before
        words = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data[solid])])
        coded = words.dictionary_encode()
        self.codes, self.distinct = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
        bounds = np.searchsorted(at, ends)
        self.starts, self.ends = bounds[:-1], bounds[1:]

    def raw(self) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the distinct words, one after another, and where each begins (with the end added)."""
        array = self.distinct
        ends = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
        data = array.buffers()[2]
        return (np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8))[ends[0] : ends[-1]], ends - ends[0]

    def hashes(self) -> np.ndarray:
        """XXH64 of each distinct word, unsigned."""
        return np.fromiter(map(xxhash.xxh64_intdigest, self.distinct.to_pylist()), np.uint64, len(self.distinct))


def sums_between(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of ``values[start:end]`` for each pair."""
    total = np.concatenate((np.zeros(1, np.float64 if values.dtype.kind == "f" else np.int64), np.cumsum(values, dtype=np.float64 if values.dtype.kind == "f" else np.int64)))
    return total[ends] - total[starts]
