"""Blocks of rows in the shared folder: what is searched is written there once, and tasks that hold questions map it.

Only the questions go through a shuffle, so what moves grows with their number and not with the product of both sides.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leksika.session import new_path


class Folder:
    """Files in the shared folder: written whole, then renamed, so that a task that runs twice does no harm."""

    def __init__(self, uri: str):
        self.uri = uri

    def local(self) -> str | None:
        """The path, if the folder is one of the file system that workers share."""
        scheme = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):", self.uri)
        if scheme is None:
            return self.uri
        return re.sub("^file:(//)?", "", self.uri) if scheme[1] == "file" else None

    def remote(self) -> tuple:
        """File system and path of a store that can't be mapped."""
        import pyarrow.fs as pafs  # large, and of no use on a mounted folder

        return pafs.FileSystem.from_uri(re.sub(r"^([A-Za-z0-9+.-]+):/(?!/)", r"\1:///", self.uri))

    def write(self, name: str, data: list[np.ndarray]) -> None:
        path = self.local()
        if path is not None:
            os.makedirs(path, exist_ok=True)
            part = f"{path}/.{name}-{uuid.uuid4().hex}"
            with open(part, "wb") as out:
                for a in data:
                    out.write(np.ascontiguousarray(a).data)
            os.replace(part, f"{path}/{name}")
            return
        fs, path = self.remote()
        fs.create_dir(path, recursive=True)
        part = f"{path}/.{name}-{uuid.uuid4().hex}"
        with fs.open_output_stream(part) as out:
            for a in data:
                out.write(np.ascontiguousarray(a).tobytes())
        fs.move(part, f"{path}/{name}")

    def map(self, name: str) -> np.ndarray:
        """The file's bytes, mapped where the store can be; none if it was never written."""
        path = self.local()
        if path is not None:
            name = f"{path}/{name}"
            return np.memmap(name, np.uint8, "r") if os.path.exists(name) and os.path.getsize(name) else np.empty(0, np.uint8)
        fs, path = self.remote()
        if not fs.get_file_info(f"{path}/{name}").is_file:
            return np.empty(0, np.uint8)
        with fs.open_input_stream(f"{path}/{name}") as held:
            return np.frombuffer(held.read(), np.uint8)


def group_of(n: int) -> Column:
    """One of ``n`` groups for each row, about equally many rows in each, however rows lie in partitions."""
    return F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n)).cast("int")


class Blocks:
    """Blocks numbered from 0. One that no row was dealt to, or whose rows ``prepare`` left out, is not met."""

    def __init__(self, folder: Folder, n: int):
        self.folder, self.n = folder, n

    def read(self, numbers: Iterable[int]) -> Iterator[pa.Table]:
        for number in numbers:
            raw = self.folder.map(f"block-{number}")
            if len(raw):
                yield pa.ipc.open_stream(pa.py_buffer(raw)).read_all()


def write_blocks(rows: DataFrame, name: str, size: int, prepare: Callable[[pa.Table], pa.Table]) -> Blocks:
    """Deal ``rows`` into blocks of about ``size`` rows and write what ``prepare`` makes of each, once for all who ask.

    ``prepare`` does what would else be done for each group of questions anew: order, distinct rows, statistics.
    """
    blocks = Blocks(Folder(new_path(rows.sparkSession, name)), max(1, -(-rows.count() // size)))

    def write(table: pa.Table) -> pa.Table:
        made = prepare(table.drop_columns(["block"]))
        if made.num_rows:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, made.schema) as out:
                out.write_table(made.combine_chunks())
            blocks.folder.write(f"block-{table.column('block')[0].as_py()}", [np.frombuffer(sink.getvalue(), np.uint8)])
        return pa.table({"n": pa.array([made.num_rows], pa.int64())})

    rows.withColumn("block", group_of(blocks.n)).groupBy("block").applyInArrow(write, "n long").agg(F.sum("n")).collect()
    return blocks


def answered(questions: DataFrame, blocks: Blocks, answer: Callable[[pa.Table, Iterator[pa.Table]], pa.Table], schema: str | T.StructType, size: int, least: int = 64) -> DataFrame:
    """What ``answer`` makes of each group of questions and all blocks, one after another.

    A group has up to ``size`` questions, or as few as ``least`` where tasks would be too few for the cores. Where groups still
    are fewer than the tasks wanted, each is asked by several tasks, of which each goes through a range of the blocks; the
    questions that this repeats are at most ``least`` for each task wanted. The caller merges what the ranges return.
    """
    asked, wanted = questions.count(), 4 * questions.sparkSession.sparkContext.defaultParallelism
    groups = max(1, -(-asked // size), min(-(-asked // least), wanted))
    ranges = min(blocks.n, max(1, wanted // groups))
    tasks = groups * ranges
    names = [f.name for f in questions.schema]
    parts = F.explode(F.sequence(F.lit(0), F.lit(ranges - 1)))
    dealt = questions.withColumn("group", group_of(groups)).withColumn("part", parts).select(*names, (F.col("group") * ranges + F.col("part")).alias("task"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        of = table.column("task").to_numpy()
        for task in np.unique(of).tolist():
            part = task % ranges
            mine = range(part * blocks.n // ranges, (part + 1) * blocks.n // ranges)
            # Tasks begin at different blocks, so that not all read the same one at once.
            turn = (task // ranges) % max(1, len(mine))
            numbers = [*mine[turn:], *mine[:turn]]
            found = answer(table.filter(pa.array(of == task)).drop_columns(["task"]), blocks.read(numbers))
            yield from found.combine_chunks().to_batches()

    return dealt.repartitionById(tasks, F.col("task")).mapInArrow(run, schema)


def first_places(groups: np.ndarray) -> np.ndarray:
    """The place of each row among those of its group, from 0; equal groups lie together."""
    starts = np.flatnonzero(np.append(True, groups[1:] != groups[:-1])) if len(groups) else np.empty(0, np.int64)
    return np.arange(len(groups)) - np.repeat(starts, np.diff(np.append(starts, len(groups))))
