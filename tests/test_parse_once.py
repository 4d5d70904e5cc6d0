"""Parsing is one map over the snapshots, whatever is done with its result."""

import re

from pyspark.sql import functions as F

from leksika.operators import parsing
from leksika.plans import derived, workflows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def made(df, name):
    return len(re.findall(rf"\b{name}\b", plan(df)))


def test_filters_behind_a_parse_neither_enter_nor_repeat_it(spark, sf):
    found = parsing.parse(derived.snapshots(spark, sf).select("raw_snapshot_id", "content", "url"))
    kept = found.where(F.col("error").isNull() & (F.size("makna") > 0) & F.col("lema").isNotNull())
    assert made(kept, "FileScan") == made(kept, "MapInArrow") == 1


def test_many_payloads_of_nested_objects(spark):
    """20,000 payloads: many minutes by expressions over maps of variants, of which each level was evaluated anew for each use."""
    content = F.lit('{"Lema": "a", "definisi": {"senses": {"arti": [{"makna": "b"}, "c"]}}, "contoh": {"examples": ["d"]}, "pos": "N; v", "varian": {"tidakBaku": "e, f"}}')
    rows = spark.range(20_000, numPartitions=4).select(F.col("id").alias("raw_snapshot_id"), F.encode(content, "UTF-8").alias("content"), F.lit("u").alias("url"))
    fields = ("lema", "makna", "contoh", "kelas_kata", "bentuk_tidak_baku", "error")
    (only,) = parsing.parse(rows).groupBy(*fields).count().collect()
    assert tuple(only) == ("a", ["b", "c"], ["d"], ["n", "v"], ["e", "f"], None, 20_000)


def test_an_import_parses_once(spark, sf):
    entries, quarantine = workflows.import_snapshots(derived.snapshots(spark, sf).select("raw_snapshot_id", "content", "url"), "official-live")
    assert made(entries, "MapInArrow") == made(quarantine, "MapInArrow") == 0
    assert entries.count() > 100 and quarantine.count() == 0
