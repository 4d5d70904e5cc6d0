"""SimHash near-duplicates: pigeonhole blocks, verified Hamming distance, connected classes.

A fingerprint has 64 bits. Two fingerprints that differ in at most ``max_bits`` (3) bits agree on at
least three of six blocks, so every close pair meets under one of the 20 choices of three blocks; the
shared key has 31 to 33 bits, so chance meetings stay rare for any corpus that fits a cluster. Equal
fingerprints are one class before any join. A bucket is compared in blocks of at most ``block`` rows;
a larger bucket is cut into blocks and every pair of blocks is a task of its own, so no task holds an
unbounded group and no close pair is lost. A task reports the links it verified as a star for each
connected class, never as all pairs. Fingerprints and classes that hold a large share of the rows are joined apart.

Defined results: a null text counts as empty, an empty text has fingerprint zero and links like any
other; texts of any length are read whole; repeated rows and ties are equal fingerprints; a row with a
null id takes part and gets the smallest id of its class; an empty table gives an empty result; other
columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leksika.llm.common import as_bytes, discard, materialise, pieces, spread_join

BLOCKS = (11, 11, 11, 11, 10, 10)
MAX_BITS = 3
#: Shingles that are counted at once.
CHUNK = 1 << 15


def block_masks() -> list[int]:
    """The 20 masks of three of the six blocks, as signed 64-bit numbers."""
    ends = np.cumsum((0, *BLOCKS)).tolist()
    blocks = [((1 << (b - a)) - 1) << a for a, b in zip(ends, ends[1:], strict=False)]
    masks = [a | b | c for a, b, c in combinations(blocks, 3)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def fingerprint(text: bytes, words: int) -> int:
    """Signed 64-bit fingerprint of a text's word shingles, repeats included."""
    tokens = text.lower().split()
    if not tokens:
        return 0
    if len(tokens) <= words:
        shingles = [b" ".join(tokens)]
    else:
        shingles = map(b" ".join, zip(*(tokens[i:] for i in range(words)), strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, 42) for s in shingles), dtype=np.uint64)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), CHUNK):
        rows = hashes[at : at + CHUNK].astype("<u8", copy=False).view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, h (hash of the text, null for null), fp (signed 64-bit) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            fps = [fingerprint(t, words) for t in as_bytes(part.column("text"))]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("h"), pa.array(fps, pa.int64())], ["doc_id", "h", "fp"])

    return texts_of(docs, id_col, text_col).mapInArrow(run, "doc_id long, h long, fp long")


def texts_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text, h (hash of the text, null for null)."""
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return picked.withColumn("h", F.when(F.col("text").isNotNull(), F.xxhash64("text")))


def close(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    return np.bitwise_count((a[:, None] ^ b[None, :]).view(np.uint64)) <= max_bits


def stars(fps: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Members and their class's smallest fingerprint, for the classes of two or more that ``near`` connects."""
    order = np.argsort(fps, kind="stable")
    near = near[np.ix_(order, order)]
    label = np.arange(len(fps))
    while True:
        low = np.where(near, label[None, :], len(fps)).min(axis=1)
        low = np.minimum(label, low)
        low = np.minimum(low, low[low])
        if (low == label).all():
            break
        label = low
    fps = fps[order]
    moved = label != np.arange(len(fps))
    return fps[moved], fps[label[moved]]


def links(classes: DataFrame, max_bits: int = MAX_BITS, block: int = 1024) -> DataFrame:
    """u, v: star edges that connect the distinct fingerprints ``fp`` exactly as their close pairs do."""
    bands = F.explode(F.array(*[F.struct(F.lit(i).alias("band"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(block_masks())]))
    return links_within(classes.select("fp", bands.alias("b")).select("b.band", "b.key", "fp"), max_bits, block)


def links_within(spread: DataFrame, max_bits: int, block: int = 1024) -> DataFrame:
    """u, v: star edges that connect the fingerprints ``fp`` of each bucket (band, key) as their close pairs do."""

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by band and key. Small buckets are settled here; of larger ones the rows go on in blocks."""
        held: list[np.ndarray] = []
        count, now, spilt = 0, None, 0
        out: list[tuple] = []

        def whole() -> np.ndarray:
            return np.concatenate(held) if held else np.empty(0, np.int64)

        def settle() -> None:
            nonlocal held, count, spilt
            fps = whole()
            if spilt and len(fps):
                out.append((fps, np.zeros(len(fps), np.int64), np.full(len(fps), now[0]), np.full(len(fps), now[1]), np.full(len(fps), spilt)))
            elif len(fps) > 1:
                u, v = stars(fps, close(fps, fps, max_bits))
                if len(u):
                    out.append((u, v, np.full(len(u), -1), np.zeros(len(u), np.int64), np.zeros(len(u), np.int64)))
            held, count, spilt = [], 0, 0

        def flush() -> Iterator[pa.RecordBatch]:
            if out:
                cols = [np.concatenate(c) for c in zip(*out, strict=True)]
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(k.to_pandas_dtype())) for c, k in zip(cols, kinds, strict=True)], ["u", "v", "band", "key", "part"])
                out.clear()

        for batch in batches:
            band, key, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            if not len(fp):
                continue
            cuts = np.flatnonzero((band[1:] != band[:-1]) | (key[1:] != key[:-1])) + 1
            starts, ends = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(fp)]))
            # Buckets of one row inside a batch need no look; the first and last may go on in another batch.
            want = np.flatnonzero((ends - starts > 1) | (starts == 0) | (ends == len(fp)))
            for s, e in zip(starts[want].tolist(), ends[want].tolist(), strict=True):
                at = (int(band[s]), int(key[s]))
                if at != now:
                    settle()
                    now = at
                for i in range(s, e, block):
                    rows = fp[i : min(e, i + block)]
                    held.append(rows)
                    count += len(rows)
                    while count > block:
                        fps = whole()
                        out.append((fps[:block], np.zeros(block, np.int64), np.full(block, now[0]), np.full(block, now[1]), np.full(block, spilt)))
                        held, count, spilt = [fps[block:]], len(fps) - block, spilt + 1
                if e < len(fp):
                    settle()
                    now = None
            yield from flush()
        settle()
        yield from flush()

    def cell(keys: tuple, rows: pa.Table) -> pa.Table:
        part = rows.column("part").to_numpy()
        fps = rows.column("fp").to_numpy()
        if keys[2].as_py() == keys[3].as_py():
            u, v = stars(fps, close(fps, fps, max_bits))
        else:
            near = close(fps, fps, max_bits) & (part[:, None] != part[None, :])
            u, v = stars(fps, near)
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    dealt = spread.repartition("band", "key").sortWithinPartitions("band", "key", "fp")
    swept = materialise(dealt.mapInArrow(sweep, "u long, v long, band int, key long, part int"), "buckets")
    found = swept.where("band < 0").select("u", "v")
    large = swept.where("band >= 0").select("band", "key", "part", F.col("u").alias("fp"))
    parts = large.groupBy("band", "key").agg((F.max("part") + 1).alias("n"))
    cells = (
        large.join(parts, ["band", "key"])
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
        .select("band", "key", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "fp")
    )
    crossed = cells.groupBy("band", "key", "i", "j").applyInArrow(cell, "u long, v long")
    return found.unionAll(crossed).distinct()


def connect(edges: DataFrame, name: str = "links") -> DataFrame:
    """node, root: the smallest node of its connected class, for every node of ``edges`` (u, v) but the roots.

    Alternating large and small stars; each round ends in a written table. The smallest neighbour of a
    node is an aggregate joined back, so no node's neighbours are gathered in one place.
    """
    edges = materialise(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)
    count = edges.count()
    last = None
    while count:
        if last is not None:
            discard(last)
        last, before = edges, count
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        large = both.join(low, both.u == low.w).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = materialise(large, name)
        low = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), "m")
        met = large.join(low, large.u == low.w)
        small = met.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(low.select(F.col("w").alias("u"), F.col("m").alias("v"))).where("u <> v")
        edges = materialise(small.distinct(), name)
        discard(large)
        count = edges.count()
        # Done when nothing changed: as many edges, and each was there before.
        if count == before and edges.join(last, ["u", "v"], "left_anti").isEmpty():
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(docs: DataFrame, words: int = 3, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id of the class that links reach)."""
    found = classified(docs, words, max_bits, id_col, text_col)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def classified(docs: DataFrame, words: int, max_bits: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, h (hash of the text), fp, root, component_id of every row."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"three of six blocks find pairs of up to {MAX_BITS} differing bits")
    fps = materialise(fingerprints(docs, words, id_col, text_col), "fingerprints")
    classes = materialise(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "classes")
    return with_components(fps, classes, connect(links(classes.select("fp"), max_bits)), "fp")


def with_components(rows: DataFrame, classes: DataFrame, roots: DataFrame, key: str) -> DataFrame:
    """``rows`` (doc_id, h, ``key``) with root and component_id, the smallest doc_id of all rows of the root.

    ``classes`` have each key with its smallest doc_id, ``roots`` (node, root) the keys that are not their own root. Keys
    and roots that hold a large share of the rows are joined apart.
    """
    rooted = materialise(classes.join(roots.withColumnRenamed("node", key), key, "left").select(key, "rep", F.coalesce("root", key).alias("root")), "rooted")
    least = materialise(rooted.groupBy("root").agg(F.min("rep").alias("component_id")), "least")
    labelled = materialise(spread_join(rooted, least, "root", "component_id").select(key, F.struct("root", "component_id").alias("of")), "labelled")
    return spread_join(rows, labelled, key, "of").select(*rows.columns, "of.root", "of.component_id")


def one_of_each(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with one document of each class: that of the smallest doc_id, then of the smallest hash of its text; rows without an id stay.

    ``found`` has doc_id, h (xxhash64 of the text as a string, null for null) and root of each row. A row is told by its
    id and text, so rows that share an id and differ in text are judged each for itself; of rows alike in both one stays.
    """
    place = F.struct(F.col("doc_id").alias("i"), F.col("h").isNull().alias("m"), F.col("h").alias("h"))
    rows = found.where("doc_id is not null").select("root", place.alias("place"))
    first = materialise(rows.groupBy("root").agg(F.min("place").alias("first")), "first")
    placed = rows.groupBy("root", "place").agg(F.count("*").alias("rows"))
    judged = materialise(spread_join(placed, first, "root", "first").withColumn("stays", F.col("place") == F.col("first")).where("not stays or rows > 1"), "found")
    # Texts are dealt out once, by merge at every size: which side fits a broadcast would change with it.
    names = docs.columns
    carried = [f"c{i}" for i in range(len(names))]
    of = dict(zip(names, carried, strict=True))
    text = F.col(of[text_col]).cast("string")
    digest = F.when(text.isNotNull(), F.xxhash64(text))
    rows = docs.toDF(*carried)
    mine = F.struct(F.col(of[id_col]).cast("long").alias("i"), digest.isNull().alias("m"), digest.alias("h"))
    gone = judged.select(F.col("place").alias("gone")).hint("merge")
    rows = rows.withColumn("place", mine)
    kept = rows.join(gone, rows["place"].eqNullSafe(gone["gone"]), "left_anti").select(*[F.col(c).alias(n) for n, c in of.items()])
    again = judged.where("stays").select(F.col("place").alias("again"))
    if again.isEmpty():
        return kept
    repeated = rows.join(again, rows["place"].eqNullSafe(again["again"]), "left_semi").dropDuplicates(["place"])
    return kept.unionAll(repeated.select(*[F.col(c).alias(n) for n, c in of.items()]))


def drop_duplicates(docs: DataFrame, words: int = 3, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each class of ``near_duplicates``."""
    return one_of_each(docs, classified(docs, words, max_bits))
