"""Rows in one global order without one task for all: ranks, and digests over all lines."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from leksika.session import written

#: Hashes below one node of a tree digest.
NODE = 4096

#: The same for DuckDB, over a table ``leaf`` (k, h) of up to NODE * NODE records.
TREE_SQL = """node AS (SELECT rank // 4096 AS rank, sha256(string_agg(h, chr(10) ORDER BY rank)) AS h FROM (SELECT h, row_number() OVER (ORDER BY k, h) - 1 AS rank FROM leaf) AS r GROUP BY rank // 4096),
tree AS (SELECT (SELECT count(*) FROM leaf) AS n, CASE WHEN count(*) = 1 THEN max(h) ELSE sha256(string_agg(h, chr(10) ORDER BY rank)) END AS fingerprint FROM node)"""


def ranked(rows: DataFrame, *order: str, ranges: int | None = None) -> DataFrame:
    """``rows`` with ``rank`` from 0 in order of some columns, nulls first, written to the shared folder.

    Rows are dealt by ranges and sorted within them; a row's rank is its place in its range plus the rows of the ranges
    before, so a row costs the same however many ranges there are. Rows that are equal in all of ``order`` stand in any order.
    """
    by = [F.col(c).asc_nulls_first() for c in order]
    dealt = rows.repartitionByRange(ranges, *by) if ranges else rows.repartitionByRange(*by)
    placed = dealt.sortWithinPartitions(*by).withColumn("__part", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    held = written(placed, "ranked")
    counts = held.groupBy("__part").agg(F.count("*").alias("__n"))  # a row for each task that wrote
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    return held.join(F.broadcast(starts), "__part").withColumn("rank", F.col("__before") + F.col("__at")).select(*rows.columns, "rank")


def sequenced(rows: DataFrame, key: str, *order: str, ranges: int | None = None) -> DataFrame:
    """``rows`` with ``sequence`` from 1 among those of their key, written to the shared folder.

    Two levels: ranges of (key, order) over all rows, which part a key that has too many as they part any rows, then
    the place behind the key's first rank. So no task has all rows of a key.
    """
    placed = ranked(rows, key, *order, ranges=ranges)
    firsts = placed.groupBy(F.col(key).alias("__key")).agg(F.min("rank").alias("__first"))
    return placed.join(firsts, F.col(key).eqNullSafe(F.col("__key"))).withColumn("sequence", (F.col("rank") - F.col("__first") + 1).cast("int")).select(*rows.columns, "sequence")


def tree_digest(records: DataFrame, key: str, record: Column) -> DataFrame:
    """N, fingerprint: one hash over all records in order of key, whatever order and partitions they came in.

    Every record is hashed where it is. ``NODE`` hashes that follow each other by rank, joined by newlines, are hashed
    to a node, these to nodes above, until there is one: a tree that only the order of the records gives, with no task that
    has more than ``NODE`` hashes. It is not the hash of all lines in a row, which no two tasks can share: see ``line_digest``.
    """
    leaves = ranked(records.select(F.col(key).alias("k"), F.sha2(record, 256).alias("h")), "k", "h")
    n = size = leaves.count()
    level = leaves.select("rank", "h")
    while True:
        hashes = F.transform(F.array_sort(F.collect_list(F.struct("rank", "h"))), lambda x: x["h"])
        level = level.groupBy(F.floor(F.col("rank") / NODE).alias("rank")).agg(F.sha2(F.array_join(hashes, "\n"), 256).alias("h"))
        size = -(-size // NODE)
        if size <= 1:
            break
    if not n:
        return records.sparkSession.range(1).select(F.lit(0).cast("long").alias("n"), F.sha2(F.lit(""), 256).alias("fingerprint"))
    return level.select(F.lit(n).cast("long").alias("n"), F.col("h").alias("fingerprint"))


def line_digest(records: DataFrame, *key: str, line: Column) -> DataFrame:
    """N, digest: the SHA-256 of all lines in order of key, joined by newlines, as any other tool computes it.

    The hash of a line's bytes needs the state that the lines before leave, so this is one pass in one task, by
    definition; all before it is not: lines are made, dealt by ranges and sorted in all tasks, and the one that hashes
    takes range after range, a batch at a time. Where the value need not be that of one file, take ``tree_digest``.
    """

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, n = hashlib.sha256(), 0
        for batch in batches:
            texts = batch.column(0).fill_null("").to_pylist()
            if texts:
                whole.update(("\n" * bool(n) + "\n".join(texts)).encode())
                n += len(texts)
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64()), "digest": pa.array([whole.hexdigest()])})

    lines = records.select(*key, line.alias("__line"))
    by = [F.col(c).asc_nulls_first() for c in (*key, "__line")]
    folded = lines.repartitionByRange(*by).sortWithinPartitions(*by).select("__line").coalesce(1).mapInArrow(fold, "n long, digest string")
    return folded.agg(F.coalesce(F.max("n"), F.lit(0)).alias("n"), F.coalesce(F.max("digest"), F.sha2(F.lit(""), 256)).alias("digest"))  # no task runs over no rows


#: Rows of a key that one task walks at a time.
STRETCH = 1 << 17


def _over_stretches(rows: DataFrame, key: str, order: tuple[str, ...], name: str, within: Column, ending: Column, carried: Column, joined: Column, size: int) -> DataFrame:
    """Two levels of a running value: in stretches of ranks, and from the ends of a key's earlier stretches (a row for each ``size`` rows)."""
    placed = ranked(rows, key, *order).withColumn("__stretch", F.floor(F.col("rank") / size))
    here = placed.withColumn("__here", within.over(Window.partitionBy(key, "__stretch").orderBy("rank")))
    ends = placed.groupBy(F.col(key).alias("__key"), F.col("__stretch").alias("__at")).agg(ending.alias("__end"))
    before = Window.partitionBy("__key").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    earlier = ends.select("__key", "__at", carried.over(before).alias("__carried"))
    met = here.join(earlier, F.col(key).eqNullSafe(F.col("__key")) & (F.col("__stretch") == F.col("__at")))
    return met.select(*rows.columns, joined.alias(name))


def last_known(rows: DataFrame, key: str, *order: str, value: Column, name: str, size: int = STRETCH) -> DataFrame:
    """``rows`` with the last ``value`` that isn't null among those of their key up to them; null if there is none. A key of any size is many tasks' work.

    Rows that are equal in all of ``order`` stand in any order; a null key is a key.
    """
    ending = F.max_by(value, F.when(value.isNotNull(), F.col("rank")))
    return _over_stretches(rows, key, order, name, F.last(value, ignorenulls=True), ending, F.last("__end", ignorenulls=True), F.coalesce("__here", "__carried"), size)


def running_sum(rows: DataFrame, key: str, *order: str, value: Column, name: str, size: int = STRETCH) -> DataFrame:
    """``rows`` with the sum of ``value`` over those of their key up to them, nulls as 0, in the order of ``last_known``."""
    summed = F.sum(F.coalesce(value, F.lit(0)))
    return _over_stretches(rows, key, order, name, summed, summed, F.sum("__end"), F.col("__here") + F.coalesce("__carried", F.lit(0)), size)
