"""Operator 11, leaderboard change feed: what each batch of amounts changes on the boards of the best-selling items.

A board is the ``SIZE`` items of highest positive revenue of one owner (a nation), ties to the smaller item, after each
day. Lines come in batches; each batch is one start of a stateful streaming query on one checkpoint.

*State.* A shard is some of the items of one owner. Its map state ``bands`` maps bands of revenue (two to a doubling)
to sets of items, beside a map state ``revenues`` with each item's running revenue in pages. A day's amounts move their
items from band to band; then the highest occupied bands are scanned until ``SIZE`` items are collected. An owner has
one shard for each ``LINES`` lines, so an owner with a third of all rows is as many tasks as its rows need. Amounts of one
item and day are added up in the map tasks before they are dealt, so an item with a third of all rows is a few rows.

*Merge.* A shard hands on its board of each day on which it changed, with what left it. The boards of up to ``FAN`` shards
(or merged boards) meet in one group, day by day; owners with more shards have more levels of such groups. The last
level's changes are the feed. What stands at the end of a batch is kept for the next one.

Each batch is written under its number, so that one that runs twice after a failure is written once.

Defined results: lines without an owner or without an ``items`` row are no part of any revenue but count for lateness;
equal lines count each; null ids or numbers in a line are empty in its hash; a null amount is quantity by price, and 0
where that is null too; a repeated vendor or item row counts once (smallest nation, highest price); equal revenues go by
smaller item; an empty table has an empty feed; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from leksika.llm.common import spread_join, table, work_path

#: Items on a board; days that a line may be older than the newest day of all earlier batches.
SIZE, LATE = 10, 3
#: Lines of one shard, shards that are merged in one group, pages of an item's revenue in a shard.
LINES, FAN, PAGES = 1 << 15, 64, 8
#: Groups of an item and day that a map task holds before it hands them on.
HELD = 1 << 20
#: Owners up to which the number of their shards is broadcast; beyond, it is joined.
FEW = 10_000

ROWS = "owner int, item_id long, day long, cents long"
BOARDS = "owner int, node int, day long, items array<long>, cents array<long>, changed array<long>, old_ranks array<int>, new_ranks array<int>, afterwards array<long>"
FEED = "nation_id int, arrival_day long, item_id long, batch int, change string, old_rank int, new_rank int, revenue long"

#: How state is kept. The session that runs the streams is a child of the caller's, whose own settings stay.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # else each store, however small, takes 4 MB of disk
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "128",
    "spark.sql.streaming.stateStore.maintenanceInterval": "5s",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",  # a start has one batch, so that no store is asked again; else an executor has all of its stores open
    "spark.sql.streaming.minBatchesToRetain": "2",
}


def bands_of(cents: np.ndarray) -> np.ndarray:
    """The band of each revenue, two to a doubling, higher for more; 0 for none or less."""
    part, power = np.frexp(np.maximum(cents, 1).astype(np.float64))
    return np.where(cents > 0, power * 2 + (part >= 0.75), 0)


def first_of(items: list[int], cents: list[int], size: int = SIZE) -> list[tuple[int, int]]:
    """The ``size`` first (item, cents), highest first, ties to the smaller item."""
    return sorted(zip(items, cents, strict=True), key=lambda x: (-x[1], x[0]))[:size]


def board_row(node: int, day: int, old: list[tuple[int, int]], new: list[tuple[int, int]], left: dict[int, int]) -> tuple:
    """A board and what changed on it; ranks of 0 are off the board; ``left`` has the revenue of items that went."""
    before, after = {i: r for r, (i, _) in enumerate(old, 1)}, {i: r for r, (i, _) in enumerate(new, 1)}
    now = dict(new)
    changed = [i for i in {**after, **before} if before.get(i, 0) != after.get(i, 0)]
    return (node, day, [i for i, _ in new], [c for _, c in new], changed, [before.get(i, 0) for i in changed], [after.get(i, 0) for i in changed], [now[i] if i in now else left[i] for i in changed])


def frame(owner: int, rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame([(owner, *r) for r in rows], columns=[c.split()[0] for c in BOARDS.split(", ")])


class Ladder(StatefulProcessor):
    """One shard: bands of revenue with their items, and the items' revenues."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.bands = handle.getMapState("bands", "band int", "items binary")
        self.revenues = handle.getMapState("revenues", "page int", "items binary, cents binary")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        came = pd.concat(list(rows))
        day, item, cents = (came[c].to_numpy(np.int64) for c in ("day", "item_id", "cents"))
        order = np.lexsort((item, day))
        day, item, cents = day[order], item[order], cents[order]
        first = np.flatnonzero(np.append(True, (day[1:] != day[:-1]) | (item[1:] != item[:-1])))
        day, item, cents = day[first], item[first], np.add.reduceat(cents, first)

        # The revenues of the pages that are touched, in order of items, and the items that come, in their order.
        touched, at = np.unique(item, return_inverse=True)
        pages = np.unique(touched % PAGES).tolist()
        ids, self.now = (np.concatenate(x) for x in zip(*map(self.page, pages), strict=True))
        new = touched[~np.isin(touched, ids)]
        ids, self.now = np.append(ids, new), np.append(self.now, np.zeros(len(new), np.int64))
        order = np.argsort(ids)
        self.ids, self.now = ids[order], self.now[order]
        self.touched, self.places, self.elsewhere = touched, np.searchsorted(self.ids, touched), {}
        self.stored = {k[0] for k in self.bands.keys()}  # at most 130, whatever the number of items
        self.sets: dict[int, set[int]] = {}
        before = bands_of(self.now[self.places])

        out, board = [], self.board()
        starts = np.flatnonzero(np.append(True, day[1:] != day[:-1]))
        for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(day)], strict=True):
            places = self.places[at[start:end]]
            old = bands_of(self.now[places])
            self.now[places] += cents[start:end]
            self.move(item[start:end], old, bands_of(self.now[places]))
            board, was = self.board(), board
            if board != was:
                revenue = dict(zip(gone := [i for i, _ in was], self.revenue(gone), strict=True))
                out.append(board_row(key[1], int(day[start]), was, board, revenue))

        for page in pages:
            own = self.ids % PAGES == page
            self.revenues.updateValue((page,), (self.ids[own].tobytes(), self.now[own].tobytes()))
        after = bands_of(self.now[self.places])
        moved = before != after
        for band in np.unique(np.append(before[moved], after[moved])).tolist():
            if band:
                held = np.union1d(np.setdiff1d(self.kept(band), touched[moved & (before == band)], assume_unique=True), touched[moved & (after == band)])
                if len(held):
                    self.bands.updateValue((band,), (held.tobytes(),))
                elif band in self.stored:
                    self.bands.removeKey((band,))
        if out:
            yield frame(key[0], out)

    def page(self, page: int) -> tuple[np.ndarray, np.ndarray]:
        held = self.revenues.getValue((page,)) or (b"", b"")
        return np.frombuffer(held[0], np.int64), np.frombuffer(held[1], np.int64)

    def kept(self, band: int) -> np.ndarray:
        """The items of a band as the batch found it."""
        return np.frombuffer(self.bands.getValue((band,))[0] if band in self.stored else b"", np.int64)

    def move(self, items: np.ndarray, old: np.ndarray, new: np.ndarray) -> None:
        """Move a day's items between the bands that have been scanned; the others are read when they are."""
        for band, held in self.sets.items():
            held.difference_update(items[(old == band) & (new != band)].tolist())
            held.update(items[(new == band) & (old != band)].tolist())

    def items(self, band: int) -> set[int]:
        """The items of a band now: those that stayed out of the batch, and those of the batch whose revenue is in it."""
        if band not in self.sets:
            own = self.touched[bands_of(self.now[self.places]) == band]
            self.sets[band] = {*np.setdiff1d(self.kept(band), self.touched, assume_unique=True).tolist(), *own.tolist()}
        return self.sets[band]

    def revenue(self, items: list[int]) -> list[int]:
        wanted = np.array(items, np.int64)
        at = np.minimum(np.searchsorted(self.ids, wanted), len(self.ids) - 1)
        for page in set((wanted[self.ids[at] != wanted] % PAGES).tolist()) - self.elsewhere.keys():
            self.elsewhere[page] = dict(zip(*(x.tolist() for x in self.page(page)), strict=True))
        return [int(self.now[j]) if self.ids[j] == i else self.elsewhere[i % PAGES][i] for i, j in zip(items, at.tolist(), strict=True)]

    def board(self) -> list[tuple[int, int]]:
        """The highest occupied bands until ``SIZE`` items are collected."""
        found: list[int] = []
        for band in sorted(self.stored.union(bands_of(self.now[self.places]).tolist()) - {0}, reverse=True):
            found += self.items(band)
            if len(found) >= SIZE:
                break
        return first_of(found, self.revenue(found))

    def close(self) -> None:
        pass


def added_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Amounts of one item and day of a map task as one row."""

    def summed(parts: list[pa.Table]) -> pa.Table:
        t = pa.concat_tables(parts).group_by(["owner", "item_id", "day"]).aggregate([("cents", "sum")])
        return t.rename_columns([c.removesuffix("_sum") for c in t.column_names]).select(["owner", "item_id", "day", "cents"])

    held: list[pa.Table] = []
    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        if sum(t.num_rows for t in held) >= HELD:
            held = [summed(held)]
            if held[0].num_rows >= HELD // 2:
                yield from held.pop().combine_chunks().to_batches()
    if held:
        yield from summed(held).combine_chunks().to_batches()


def merged(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """The board of up to ``FAN`` nodes on each day; what stands (its day is null) comes first and last."""
    owner, node = (int(x) for x in key)
    boards: dict[int, tuple[list[int], list[int]]] = {}
    for r in rows[rows["day"].isna()].itertuples():
        boards[int(r.below)] = (list(r.items), list(r.cents))

    def board() -> list[tuple[int, int]]:
        return first_of([i for x, _ in boards.values() for i in x], [c for _, x in boards.values() for c in x])

    out, now = [], board()
    for day, came in rows[rows["day"].notna()].sort_values(["day", "below"]).groupby("day", sort=True):
        left: dict[int, int] = {}
        for r in came.itertuples():
            boards[int(r.below)] = (list(r.items), list(r.cents))
            left.update(zip(r.changed, r.afterwards, strict=True))
        for ids, cents in boards.values():
            left.update(zip(ids, cents, strict=True))
        now, was = board(), now
        if now != was:
            out.append((*board_row(node, int(day), was, now, left), None))
    stand = [(node, None, ids, cents, [], [], [], [], below) for below, (ids, cents) in boards.items()]
    found = pd.DataFrame([(owner, *r) for r in out + stand], columns=[*(c.split()[0] for c in BOARDS.split(", ")), "below"])
    return found.astype({"day": "Int64", "below": "Int64"})


class ChangeFeed:
    """The feed of one checkpoint: ``advance`` starts the stateful query anew for the next batch.

    ``sizes``: owner, shards; the number of shards of each owner, which stays as it is.
    """

    def __init__(self, spark: SparkSession, path: str, sizes: DataFrame, owners: int, shards: int):
        self.path, self.levels = path, max(1, math.ceil(math.log(max(1, shards), FAN)))
        self.spark = spark.newSession()
        for name, value in {**STATE, **{k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone")}}.items():
            self.spark.conf.set(name, value)
        sizes = self.spark.read.schema(sizes.schema).parquet(f"{path}/sizes")
        self.sizes = F.broadcast(sizes) if owners <= FEW else sizes
        self.before: int | None = None

    def advance(self, number: int, folder: str, floor: int | None) -> None:
        """Feed the files in ``folder``; lines of a day below ``floor`` - ``LATE`` are dropped."""
        move(self.spark, folder, f"{self.path}/fed/{number}")
        lines = self.spark.readStream.schema(f"{ROWS}, line_day long").option("recursiveFileLookup", "true").parquet(f"{self.path}/fed")
        if floor is not None:
            lines = lines.where(F.col("line_day") + LATE >= floor)
        rows = lines.select("owner", "item_id", "day", "cents").mapInArrow(added_up, ROWS)
        dealt = rows.join(self.sizes, "owner").withColumn("node", F.pmod(F.xxhash64("item_id"), "shards").cast("int"))
        boards = dealt.groupBy("owner", "node").transformWithStateInPandas(Ladder(), BOARDS, "Update", "None")
        query = boards.writeStream.foreachBatch(lambda df, _: self.commit(df, number)).outputMode("update").option("checkpointLocation", f"{self.path}/checkpoint").trigger(availableNow=True).start()
        query.awaitTermination()
        self.before = number
        remove(self.spark, f"{self.path}/fed/{number}")

    def commit(self, boards: DataFrame, number: int) -> None:
        """Merge the shards' boards level by level and write what each level saw under the batch's number."""
        for level in range(self.levels):
            rows = boards.withColumn("below", F.col("node").cast("long"))
            if self.before is not None:
                rows = rows.unionByName(boards.sparkSession.read.schema(f"{BOARDS}, below long").parquet(f"{self.path}/level{level}/batch{self.before}").where("day is null"))
            rows = rows.withColumn("node", F.floor(F.col("below") / FAN).cast("int"))
            to = f"{self.path}/level{level}/batch{number}"
            rows.groupBy("owner", "node").applyInPandas(merged, f"{BOARDS}, below long").write.mode("overwrite").parquet(to)
            boards = boards.sparkSession.read.schema(f"{BOARDS}, below long").parquet(to).where("day is not null").drop("below")
        last = boards.select("owner", "day", F.explode(F.arrays_zip("changed", "old_ranks", "new_ranks", "afterwards")).alias("c"))
        rank = lambda c: F.when(F.col(f"c.{c}") > 0, F.col(f"c.{c}"))
        last.select(
            F.col("owner").alias("nation_id"), F.col("day").alias("arrival_day"), F.col("c.changed").alias("item_id"), F.lit(number).alias("batch"),
            F.when(F.col("c.old_ranks") == 0, "enter").when(F.col("c.new_ranks") == 0, "exit").otherwise("move").alias("change"),
            rank("old_ranks").alias("old_rank"), rank("new_ranks").alias("new_rank"), F.col("c.afterwards").alias("revenue"),
        ).write.mode("overwrite").parquet(f"{self.path}/feed/batch{number}")


def hadoop(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def move(spark: SparkSession, folder: str, to: str) -> None:
    files, target = hadoop(spark, to)
    files.mkdirs(target.getParent())
    files.rename(hadoop(spark, folder)[1], target)


def remove(spark: SparkSession, folder: str) -> None:
    files, target = hadoop(spark, folder)
    files.delete(target, True)


def hashed(lines: DataFrame) -> DataFrame:
    """``lines`` with their day, arrival day and batch, which their hash gives."""
    h = F.crc32(F.concat_ws(",", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("sale_id", "item_id", "vendor_id", "line_no"))))
    picked = lines.select("sale_id", "item_id", "vendor_id", "line_no", "quantity", "amount", "flag", F.unix_date(F.to_date("shipped_at")).cast("long").alias("shipped"))
    dated = picked.withColumn("h", h).withColumn("line_day", F.coalesce("shipped", 19723 + F.col("h") % 150))
    arrived = F.col("line_day") + F.col("h") % 7 + F.when(F.col("h") % 5 == 0, 20).otherwise(0)
    return dated.withColumn("day", arrived).withColumn("batch", F.least(F.lit(10), 1 + F.floor((F.col("day") - 19723) * 10 / 180)).cast("int"))


def priced(lines: DataFrame, vendors: DataFrame, items: DataFrame) -> DataFrame:
    """owner, item_id, day, cents, line_day, batch of the lines whose vendor has a nation and whose item is known.

    Vendors and items grow with the lines and have no bound, so they are not broadcast but for those with more than one in
    ``HOT`` lines, whose lines are dealt to all tasks (``spread_join``).
    """
    cents = lambda c: F.floor(100 * F.col(c) + F.lit(0.5))
    owners = vendors.where("vendor_id is not null and nation_id is not null").groupBy("vendor_id").agg(F.min("nation_id").cast("int").alias("owner"))
    prices = items.where("item_id is not null").groupBy("item_id").agg(F.struct(F.max("price").alias("price")).alias("of"))
    own = lines.select("vendor_id", "item_id", "day", "line_day", "batch", cents("amount").alias("own"), F.when(F.col("amount").isNull(), F.col("quantity")).alias("quantity"), F.when(F.col("flag") == "swapped", -1).otherwise(1).alias("sign"))
    owned = spread_join(own, owners.hint("merge"), "vendor_id", "owner", lines).where("owner is not null").drop("vendor_id")
    met = spread_join(owned, prices.hint("merge"), "item_id", "of", lines).where("of is not null").select("*", F.col("of.price").alias("price"))
    return met.select("owner", "item_id", "day", (F.col("sign") * F.coalesce("own", F.col("quantity") * cents("price"), F.lit(0))).cast("long").alias("cents"), "line_day", "batch")


def change_feed(lines: DataFrame, vendors: DataFrame, items: DataFrame) -> DataFrame:
    """The feed of all lines, cut into batches that are fed in order, each by a start of its own."""
    spark = lines.sparkSession
    path, dated = work_path(spark, "leaderboard"), hashed(lines)
    newest = sorted((r.batch, r.newest) for r in dated.groupBy("batch").agg(F.max("line_day").alias("newest")).collect())
    priced(dated, vendors, items).write.partitionBy("batch").parquet(f"{path}/lines")
    feed = spark.createDataFrame([], FEED)
    sizes = spark.read.schema(f"{ROWS}, line_day long, batch int").parquet(f"{path}/lines").groupBy("owner").agg(F.ceil(F.count("*") / LINES).cast("int").alias("shards"))
    sizes.write.parquet(f"{path}/sizes")
    sizes = spark.read.schema("owner int, shards int").parquet(f"{path}/sizes")
    owners, shards = sizes.agg(F.count("*"), F.max("shards")).first()
    if not owners:
        return feed
    run, floor = ChangeFeed(spark, path, sizes, owners, shards), None
    there, root = hadoop(spark, f"{path}/lines")
    for number, day in newest:
        if there.exists(hadoop(spark, f"{path}/lines/batch={number}")[1]):
            run.advance(number, f"{path}/lines/batch={number}", floor)
        floor = day if floor is None else max(floor, day)
    for part in ("lines", "fed", "checkpoint", *(f"level{k}" for k in range(run.levels))):
        remove(spark, f"{path}/{part}")
    return spark.read.schema(FEED).option("recursiveFileLookup", "true").parquet(f"{path}/feed")


def sale_boards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change_feed(*(table(spark, sf_dir, t) for t in ("sale_lines", "vendors", "items")))


#: crc32 by its bit rule, then running revenues, boards of each day on which a nation has lines, and their differences.
SQL = """
WITH raw AS (
  SELECT *, coalesce(sale_id::varchar, '') || ',' || coalesce(item_id::varchar, '') || ',' || coalesce(vendor_id::varchar, '') || ',' || coalesce(line_no::varchar, '') AS k FROM sale_lines
), bytes AS (
  SELECT *, list_prepend(4294967295::bigint, list_transform(range(1, length(k) + 1), lambda i: ord(substr(k, i, 1))::bigint)) AS b FROM raw
), hashed AS (
  SELECT *, xor(list_reduce(b, lambda c, x: list_reduce([xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: xor(a >> 1, 3988292384::bigint * (a & 1)))), 4294967295::bigint) AS h FROM bytes
), dated AS (
  SELECT *, coalesce(date_diff('day', DATE '1970-01-01', shipped_at::date), 19723 + h % 150) AS s FROM hashed
), arrived AS (
  SELECT *, s + h % 7 + CASE WHEN h % 5 = 0 THEN 20 ELSE 0 END AS a FROM dated
), cut AS (
  SELECT *, least(10, 1 + floor((a - 19723) * 10 / 180))::int AS batch FROM arrived
), newest AS (
  SELECT batch, max(max(s)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier FROM cut GROUP BY batch
), sums AS (
  SELECT v.nation_id, c.item_id, c.a, c.batch,
    sum((CASE WHEN c.flag = 'swapped' THEN -1 ELSE 1 END) * coalesce(floor(100 * c.amount + 0.5)::bigint, c.quantity * floor(100 * i.price + 0.5)::bigint, 0))::bigint AS cents
  FROM cut c JOIN newest n USING (batch) JOIN vendors v ON v.vendor_id = c.vendor_id JOIN items i ON i.item_id = c.item_id
  WHERE v.nation_id IS NOT NULL AND (n.earlier IS NULL OR c.s + 3 >= n.earlier) GROUP BY ALL
), days AS (SELECT nation_id, a, batch, lag(a) OVER (PARTITION BY nation_id ORDER BY a) AS before FROM (SELECT DISTINCT nation_id, a, batch FROM sums)
), running AS (
  SELECT nation_id, item_id, a, coalesce(lead(a) OVER w, 1000000000) AS until, sum(cents) OVER w AS revenue FROM sums WINDOW w AS (PARTITION BY nation_id, item_id ORDER BY a)
), daily AS (
  SELECT d.nation_id, d.a, d.batch, d.before, r.item_id, r.revenue::bigint AS revenue,
    CASE WHEN r.revenue > 0 THEN row_number() OVER (PARTITION BY d.nation_id, d.a ORDER BY r.revenue > 0 DESC, r.revenue DESC, r.item_id) END AS place
  FROM days d JOIN running r ON r.nation_id = d.nation_id AND r.a <= d.a AND d.a < r.until
), ranked AS (SELECT *, CASE WHEN place <= 10 THEN place END AS rank FROM daily
), board AS (SELECT * FROM ranked WHERE rank IS NOT NULL
), both_sides AS (
  SELECT n.nation_id, n.a, n.batch, n.item_id, o.rank AS old_rank, n.rank AS new_rank, n.revenue
  FROM ranked n LEFT JOIN board o ON o.nation_id = n.nation_id AND o.item_id = n.item_id AND o.a = n.before
)
SELECT nation_id::int AS nation_id, a::bigint AS arrival_day, item_id::bigint AS item_id, batch,
  CASE WHEN old_rank IS NULL THEN 'enter' WHEN new_rank IS NULL THEN 'exit' ELSE 'move' END AS change, old_rank::int AS old_rank, new_rank::int AS new_rank, revenue
FROM both_sides WHERE old_rank IS DISTINCT FROM new_rank
"""
