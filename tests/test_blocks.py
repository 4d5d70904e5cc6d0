"""Blocks that are written once and questions that are dealt to them."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from leksika.sources.blocks import Blocks, Folder, answered, first_places, write_blocks


def totals(left, blocks):
    rows, total = 0, 0
    for block in blocks:
        rows, total = rows + block.num_rows, total + sum(block.column("id").to_pylist())
    return pa.table({"q": left.column("q"), "rows": pa.array([rows] * left.num_rows), "total": pa.array([total] * left.num_rows), "sent": pa.array([1] * left.num_rows)})


@pytest.mark.parametrize(("questions", "size", "least"), [(500, 16, 4), (3, 4096, 64), (500, 4096, 64), (0, 16, 4)])
def test_every_question_meets_every_row_once(spark, questions, size, least):
    blocks = write_blocks(spark.range(1000).repartition(90), "numbers", 64, lambda t: t)
    assert blocks.n == 16
    asked = spark.range(questions).select(F.col("id").alias("q"))
    found = answered(asked, blocks, totals, "q long, rows long, total long, sent long", size, least).groupBy("q").agg(*[F.sum(c).alias(c) for c in ("rows", "total", "sent")]).collect()
    assert len(found) == questions and all((r["rows"], r["total"]) == (1000, 499500) for r in found)
    # A question is repeated only where there are fewer groups than tasks wanted, so what moves grows with the questions.
    tasks = 4 * spark.sparkContext.defaultParallelism
    assert all(r["sent"] <= max(1, tasks // max(1, min(-(-questions // least), tasks))) for r in found)


def test_empty_blocks_are_not_met(spark):
    blocks = write_blocks(spark.range(10), "none", 4, lambda t: t.slice(0, 0))
    assert list(blocks.read(range(blocks.n))) == []
    assert list(Blocks(Folder(blocks.folder.uri + "-not-there"), 3).read(range(3))) == []


def test_a_block_written_twice_is_whole(tmp_path):
    folder = Folder(f"file://{tmp_path}/blocks")
    for _ in range(2):
        folder.write("block-0", [np.arange(5, dtype=np.uint8), np.arange(3, dtype=np.uint8)])
    assert folder.map("block-0").tolist() == [0, 1, 2, 3, 4, 0, 1, 2]
    assert [p.name for p in (tmp_path / "blocks").iterdir()] == ["block-0"]


def test_places():
    assert first_places(np.array([4, 4, 2, 2, 2, 9])).tolist() == [0, 1, 0, 1, 2, 0]
    assert first_places(np.array([], np.int64)).tolist() == []
