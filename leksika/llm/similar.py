"""SimHash near-duplicates by similarity: texts whose sets of five-word shingles have a similarity of 0.8 or more.

Three differing bits of 64 tell texts that are all but equal; a stated similarity of shingle sets reaches further.
So what the fingerprints' blocks find is completed and verified, and the result is that of all pairs.

Fingerprints: 1,536 bits over the distinct shingles.
Pigeonhole blocks: 64 blocks of 24 bits, so fingerprints of up to 63 differing bits share a block, and most pairs of more
do (nine of ten at a similarity of 0.85). Those that share one and whose first 64 bits are close (``MOST_FIRST``) go on,
if all bits are as close as ``distance_of(LOOSE)`` says, that is a similarity of 0.5; pairs of 0.8 differ in up to some
320, of five shingles or of hundreds. They form near classes. Beyond 2^24 texts blocks are wider and fewer, so that
chance brings a text no more than some 64 others.
What these blocks leave: two sets of similarity s share at least s times the shingles of either, so they share one of
the first ``n - ceil(s * n) + 1`` of the n shingles of each, in any one order of all shingles. Texts that share one of
these and are of several near classes are compared, in all bits. Shingles that are frequent in a sample of texts come
last in the order, so a common line brings no texts together that have others; the sample changes the work only,
never the result.
Verification: all candidates form loose classes; in each of them the shingle sets themselves are compared.

Blocks of equal keys and loose classes are compared in pieces of bounded size, and each piece reports a star
for each class that links connect. In a piece the texts close to the one nearest to the bitwise majority are one
class at once, and only the others are compared with all, so a crowd of copies costs no square.

Defined results: as in ``simhash``: null counts as empty, empty texts are alike, texts are read whole,
repeated rows and equal shingle sets are one class, a row with a null id takes part, an empty table gives
an empty result. A text of up to five words is one shingle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leksika.llm import simhash
from leksika.llm.common import among_least, as_bytes, discard, materialise, pieces
from leksika.llm.ngrams import mixed, starts_of
from leksika.llm.simhash import connect, one_of_each, texts_of, with_components

WORDS, SIMILARITY, LOOSE = 5, 0.8, 0.5
LIMBS, BANDS, BITS = 24, 128, 24
SIZE = 64 * LIMBS
#: Rows of a block that are compared at once; shingles that are counted at once.
BLOCK, CHUNK = 1024, 2048
#: Ids of a key that are held at once.
LONG = 1 << 18
#: Bytes of shingle hashes that a piece of a loose class has.
PIECE_BYTES = 16 << 20
#: Texts, and frequent shingles among them, that the order of shingles is taken from at most (about, for texts).
ORDER_TEXTS, ORDER_SHINGLES, FREQUENT = 16384, 1 << 16, 8

_rng = np.random.default_rng(1)
MULTIPLIERS = _rng.integers(1 << 62, 1 << 63, LIMBS, np.uint64) * np.uint64(2) + np.uint64(1)
#: Differing bits of the first 64 up to which texts of a block go on: a mean of 9.7 and two deviations at a similarity of 0.8.
MOST_FIRST = 16
#: Random picks of bits, as tests estimate with; the stage's blocks are those of ``block_keys``.
PLACES = np.stack([_rng.choice(SIZE, BITS, replace=False) for _ in range(BANDS)])
POWERS = 1 << np.arange(BITS)


def distance_of(similarity: float) -> int:
    """Differing bits up to which a pair counts: the mean at that similarity and one deviation."""
    share = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return round(SIZE * share + math.sqrt(SIZE * share * (1 - share)))


def shingles_of(text: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; none for a text without words."""
    tokens = text.lower().split()
    if not tokens:
        return np.empty(0, np.uint64)
    shingles = {b" ".join(tokens)} if len(tokens) <= words else set(map(b" ".join, zip(*(tokens[i:] for i in range(words)), strict=False)))
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, shingles), np.uint64, len(shingles)))


def majority(hashes: np.ndarray) -> bytes:
    counts = np.zeros(SIZE, np.int64)
    for at in range(0, len(hashes), CHUNK):
        h = hashes[at : at + CHUNK, None] * MULTIPLIERS
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
        bits = np.unpackbits(h.view(np.uint8), axis=1, bitorder="little")
        # Sums of up to 255 rows fit a byte, which is the fastest to add.
        full = len(bits) // 255 * 255
        if full:
            counts += bits[:full].reshape(-1, 255, SIZE).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        counts += bits[full:].sum(axis=0, dtype=np.uint8)
    return np.packbits(2 * counts > len(hashes), bitorder="little").tobytes()


def fingerprint(text: bytes, words: int = WORDS) -> bytes:
    return majority(shingles_of(text, words))


def needed(n: int, similarity: float) -> int:
    """Shingles that a set of ``n`` shares at least with any set of that similarity."""
    return math.ceil(similarity * n - 1e-9)


def first_shingles(hashes: np.ndarray, similarity: float, frequent: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The shingles one of which any set of that similarity has among its own; ``frequent`` (sorted, with ``counts``) come last."""
    if not len(hashes):
        return hashes
    size = np.zeros(len(hashes), np.int64)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, hashes), len(frequent) - 1)
        size = np.where(frequent[at] == hashes, counts[at], 0)
    return hashes[np.argsort(size, kind="stable")[: len(hashes) - needed(len(hashes), similarity) + 1]]


def limbs(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u8").reshape(-1, LIMBS)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of each row of ``a`` and each of ``b``."""
    out = np.zeros((len(a), len(b)), np.int16)
    for k in range(LIMBS):
        out += np.bitwise_count(a[:, k, None] ^ b[None, :, k])
    return out


def classes_within(ids: np.ndarray, fps: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Members and their class's smallest id, for the classes of two or more that pairs within ``most`` bits connect."""
    ids, first = np.unique(ids, return_index=True)
    fps = fps[first]
    bits = np.unpackbits(np.ascontiguousarray(fps).view(np.uint8), axis=1, bitorder="little")
    major = np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > len(fps), bitorder="little").view("<u8")[None]
    pivot = fps[distances(fps, major).argmin()][None]
    crowd = distances(fps, pivot)[:, 0] <= most
    others = np.flatnonzero(~crowd)
    # Node 0 is the crowd, the others follow.
    n = len(others) + 1
    near = np.eye(n, dtype=bool)
    for at in range(0, len(others), 256):
        rows = others[at : at + 256]
        close = distances(fps[rows], fps) <= most
        near[1 + at : 1 + at + len(rows), 1:] = close[:, others]
        near[1 + at : 1 + at + len(rows), 0] = close[:, crowd].any(axis=1)
    near |= near.T
    label = np.arange(n)
    while True:
        low = np.where(near, label[None, :], n).min(axis=1)
        low = np.minimum(low, low[low])
        if (low == label).all():
            break
        label = low
    group = np.zeros(len(ids), np.int64)
    group[others] = label[1:]
    least = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(least, group, ids)
    root = least[group]
    return ids[root != ids], root[root != ids]


def similar_within(ids: np.ndarray, fps: np.ndarray, sets: list[np.ndarray], similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Members and their class's smallest id, for the classes of two or more that pairs of that similarity of ``sets`` connect."""
    n = len(ids)
    sizes = np.array([len(x) for x in sets])
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
    mark = np.zeros(len(codes), bool)

    def close(row: int) -> np.ndarray:
        own = codes[starts[row] : starts[row] + sizes[row]]
        mark[own] = True
        both = np.add.reduceat(mark[codes], starts, dtype=np.int64)
        mark[own] = False
        return both >= similarity * (sizes + sizes[row] - both) - 1e-9

    label = np.arange(n)
    pivot = 0
    if n > 2:
        bits = np.unpackbits(np.ascontiguousarray(fps).view(np.uint8), axis=1, bitorder="little")
        major = np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > n, bitorder="little").view("<u8")[None]
        pivot = int(distances(fps, major).argmin())
    crowd = close(pivot)
    label[crowd] = pivot
    for row in np.flatnonzero(~crowd):
        met = np.unique(label[close(row)])
        if len(met) > 1:
            label[np.isin(label, met)] = met[0]
    least = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(least, label, ids)
    root = least[label]
    return ids[root != ids], root[root != ids]


def block_keys(fps: np.ndarray, width: int = BITS) -> np.ndarray:
    """Of each row of limbs, the blocks of ``width`` bits that lie side by side, as numbers; what is left over at the end goes to none."""
    count = SIZE // width
    bits = np.unpackbits(np.ascontiguousarray(fps).view(np.uint8), axis=1, bitorder="little")[:, : count * width]
    return bits.reshape(-1, count, width) @ (1 << np.arange(width))


def near_classes(classes: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """id, near: the smallest id of the class that blocks of fingerprint bits connect, for the other ids of such classes.

    ``classes``: id, bits (the first 64 of the fingerprint), fp.
    """
    most = distance_of(min(LOOSE, similarity))
    width = max(BITS, classes.count().bit_length())

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                keys = block_keys(limbs(part.column("fp")), width)
                bands = np.tile(np.arange(keys.shape[1], dtype=np.int32), len(keys))
                firsts = np.repeat(part.column("bits").to_numpy(zero_copy_only=False), keys.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(bands), pa.array(keys.ravel()), pa.array(firsts)], ["band", "key", "fp"])

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            differ = np.bitwise_count(limbs(batch.column("a")) ^ limbs(batch.column("b"))).sum(axis=1, dtype=np.int64)
            yield batch.select(["u", "v"]).filter(pa.array(differ <= most))

    prints = classes.select("bits", "fp")
    met = simhash.links_within(prints.mapInArrow(spread, "band int, key long, fp long"), MOST_FIRST).where("u <> v").distinct()
    one = prints.groupBy("bits").agg(F.min("fp").alias("fp"))
    met = met.join(one.toDF("u", "a"), "u").join(one.toDF("v", "b"), "v").mapInArrow(close, "u long, v long")
    least = classes.groupBy("bits").agg(F.min("id").alias("rep"))
    found = with_components(classes.select("id", "bits"), least, connect(met, "close"), "bits")
    return materialise(found.where("id <> component_id").select("id", F.col("component_id").alias("near")), "near")


def links(classes: DataFrame, near: DataFrame, similarity: float = SIMILARITY, block: int = BLOCK) -> DataFrame:
    """u, v: star edges over the ids of ``classes`` (id, fp, firsts) that connect, with those of ``near``, all pairs of that similarity, and looser ones."""
    most = distance_of(min(LOOSE, similarity))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                firsts = part.column("firsts").to_pylist()
                ids, nears = (pa.array(np.repeat(part.column(c).to_numpy(zero_copy_only=False), [len(x) // 8 for x in firsts])) for c in ("id", "near"))
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(b"".join(firsts), "<i8")), ids, nears], ["key", "id", "near"])

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of rows sorted by key, the sets of ids of several near classes that share a key, each set once, told by a hash of its ids.

        Near copies share most of their keys, so most sets are met many times. A set beyond ``LONG`` ids goes on under its key.
        """
        seen: set[int] = set()
        left_key, left_ids, left_near, long = 0, np.empty(0, np.int64), np.empty(0, np.int64), False

        def rows(sets: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(sets.view(np.int64)), pa.array(ids)], ["key", "id"])

        def whole(key: np.ndarray, ids: np.ndarray, near: np.ndarray) -> pa.RecordBatch | None:
            if not len(key):
                return None
            starts = starts_of(key)
            sizes = np.diff(np.append(starts, len(key)))
            wide = ids.astype(np.uint64)
            marks = mixed(np.add.reduceat(mixed(wide, wide), starts), sizes.astype(np.uint64))
            new = np.zeros(len(starts), bool)
            new[np.unique(marks, return_index=True)[1]] = True
            new &= np.minimum.reduceat(near, starts) < np.maximum.reduceat(near, starts)
            for i in np.flatnonzero(new).tolist():
                mark = int(marks[i])
                if mark in seen:
                    new[i] = False
                else:
                    seen.add(mark)
            if len(seen) > 1 << 20:
                seen.clear()
            keep = np.repeat(new, sizes)
            return rows(np.repeat(marks, sizes)[keep], ids[keep]) if keep.any() else None

        for batch in batches:
            if not batch.num_rows:
                continue
            key, ids, near = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            key = np.concatenate((np.full(len(left_ids), left_key, np.int64), key))
            ids, near = np.concatenate((left_ids, ids)), np.concatenate((left_near, near))
            if long:  # a set that is sent on piecemeal
                same = int(np.searchsorted(key != left_key, True))
                if same:
                    yield rows(np.full(same, left_key, np.int64), ids[:same])
                key, ids, near = key[same:], ids[same:], near[same:]
                long = not len(key)
                if long:
                    left_ids = left_near = np.empty(0, np.int64)
                    continue
            last = int(np.searchsorted(key, key[-1]))
            if found := whole(key[:last], ids[:last], near[:last]):
                yield found
            left_key, left_ids, left_near = int(key[-1]), ids[last:], near[last:]
            if len(left_ids) > LONG:
                yield rows(np.full(len(left_ids), left_key, np.int64), left_ids)
                left_ids, left_near, long = np.empty(0, np.int64), np.empty(0, np.int64), True
        if len(left_ids) > 1 and (found := whole(np.full(len(left_ids), left_key, np.int64), left_ids, left_near)):
            yield found

    def linked(ids: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(ids) != 2:
            return classes_within(ids, fps, most)
        near = np.bitwise_count(fps[0] ^ fps[1]).sum() <= most
        return (ids.max(keepdims=True), ids.min(keepdims=True)) if near else (ids[:0], ids[:0])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by key, with fingerprints, in sets of up to ``block``."""
        held: list[pa.RecordBatch] = []
        now = None

        def settle() -> Iterator[pa.RecordBatch]:
            nonlocal held
            if held:
                rows, held = pa.Table.from_batches(held).combine_chunks(), []
                u, v = linked(rows.column("id").to_numpy(), limbs(rows.column("fp")))
                if len(u):
                    yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

        for batch in batches:
            key = batch.column("key").to_numpy(zero_copy_only=False)
            starts = starts_of(key)
            for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(key)], strict=True):
                if now != key[s]:
                    yield from settle()
                    now = int(key[s])
                held.append(batch.slice(s, e - s))
        yield from settle()

    def cell(key: tuple, rows: pa.Table) -> pa.Table:
        u, v = classes_within(rows.column("id").to_numpy(), limbs(rows.column("fp")), most)
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    placed = classes.select("id", "firsts").join(near, "id", "left").select("id", F.coalesce("near", "id").alias("near"), "firsts")
    spread = placed.mapInArrow(keys, "key long, id long, near long").repartition("key").sortWithinPartitions("key", "id")
    met = materialise(spread.mapInArrow(shared, "key long, id long").distinct(), "met")
    fps = classes.select("id", "fp")
    # A set beyond ``block`` is dealt into parts, and each pair of parts is a task of its own.
    large = materialise(met.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > block).select("key", F.ceil(F.col("n") / block).cast("int").alias("parts")), "large")
    known = met.join(large, "key", "left_anti").join(fps, "id").select("key", "id", "fp").repartition("key").sortWithinPartitions("key", "id")
    dealt = met.join(large, "key").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cells = dealt.select("key", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "id").join(fps, "id")
    crossed = cells.groupBy("key", "i", "j").applyInArrow(cell, "u long, v long")
    found = materialise(known.mapInArrow(compare, "u long, v long").unionAll(crossed).distinct(), "links")
    discard(met)
    return found


def frequent_shingles(texts: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the shingles that are frequent in a bounded sample of distinct ``texts``, and how many have each."""
    hashed = texts.select("text", F.xxhash64("text").alias("h"))
    total = hashed.agg(F.approx_count_distinct("h")).first()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            for text in as_bytes(part.column("text")):
                yield pa.RecordBatch.from_arrays([pa.array(shingles_of(text, words).view(np.int64))], ["s"])

    sample = hashed.where(among_least(F.col("h"), ORDER_TEXTS // 4, total)).dropDuplicates(["h"]).select("text")
    counts = sample.mapInArrow(run, "s long").groupBy("s").count().where(F.col("count") >= FREQUENT)
    top = counts.orderBy(F.desc("count"), "s").limit(ORDER_SHINGLES).toArrow()
    hashes = top.column("s").to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], top.column("count").to_numpy()[order]


def verified(loose: DataFrame, texts: DataFrame, words: int, similarity: float, block: int = BLOCK, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """u, v: star edges over the ids of ``loose`` (id, fp, root) that connect exactly the pairs of that similarity within a root."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # copies in a task go on once
        for part in pieces(batches):
            ids, sets = [], []
            for text in as_bytes(part.column("text")):
                hashes = shingles_of(text, words).tobytes()
                one = xxhash.xxh64_intdigest(hashes) - (1 << 63)
                if one not in seen:
                    seen.add(one)
                    ids.append(one)
                    sets.append(hashes)
            if len(seen) > 1 << 20:
                seen.clear()
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sets, pa.binary())], ["id", "shingles"])

    def cell(key: tuple, rows: pa.Table) -> pa.Table:
        ids, first = np.unique(rows.column("id").to_numpy(), return_index=True)
        sets = [np.frombuffer(x, "<u8") for x in rows.column("shingles").take(pa.array(first)).to_pylist()]
        u, v = similar_within(ids, limbs(rows.column("fp"))[first], sets, similarity) if len(ids) > 1 else ([], [])
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    rows = materialise(texts.mapInArrow(run, "id long, shingles binary").join(loose, "id"), "members")
    sizes = rows.groupBy("root").agg(F.count("*").alias("n"), F.sum(F.octet_length("shingles")).alias("bytes"))
    parts = sizes.select("root", F.ceil(F.greatest(F.col("n") / block, F.col("bytes") / piece_bytes)).cast("int").alias("parts")).where("parts > 1")
    dealt = rows.join(parts, "root", "left").withColumn("parts", F.coalesce("parts", F.lit(1))).withColumn("part", F.pmod(F.hash("id"), F.col("parts")))
    cells = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("root", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "id", "fp", "shingles")
    found = materialise(cells.groupBy("root", "i", "j").applyInArrow(cell, "u long, v long").distinct(), "verified")
    discard(rows)
    return found


def similar_documents(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, component_id: the smallest doc_id of the class that pairs of that similarity reach."""
    return classified(docs, words, similarity, id_col, text_col).select("doc_id", "component_id")


def classified(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, h (hash of the text), id (of the set of shingles), root, component_id of every row."""
    picked = texts_of(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(frequent_shingles(picked, words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            sets = [shingles_of(t, words) for t in as_bytes(part.column("text"))]
            ids = [xxhash.xxh64_intdigest(x.tobytes()) - (1 << 63) for x in sets]
            fps = [majority(x) for x in sets]
            bits = [int.from_bytes(x[:8], "little", signed=True) for x in fps]
            firsts = [first_shingles(x, similarity, *shared.value).tobytes() for x in sets]
            columns = [part.column("doc_id"), part.column("h"), *(pa.array(x, pa.int64()) for x in (ids, bits)), *(pa.array(x, pa.binary()) for x in (fps, firsts))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "h", "id", "bits", "fp", "firsts"])

    prints = materialise(picked.mapInArrow(run, "doc_id long, h long, id long, bits long, fp binary, firsts binary"), "prints")
    classes = materialise(prints.groupBy("id", "bits", "fp", "firsts").agg(F.min("doc_id").alias("rep")), "classes")
    rows = materialise(prints.select("doc_id", "h", "id"), "rows")
    discard(prints)
    near = near_classes(classes, similarity)
    edges = links(classes, near, similarity).unionAll(near.select(F.col("id").alias("u"), F.col("near").alias("v")))
    loose = connect(edges, "loose").withColumnRenamed("node", "id")
    loose = materialise(loose.unionAll(loose.select(F.col("root").alias("id"), "root").distinct()).join(classes.select("id", "fp"), "id"), "classed")
    least = materialise(classes.select("id", "rep"), "least")
    discard(classes)
    edges = verified(loose, picked.select("text"), words, similarity)
    discard(loose)
    return with_components(rows, least, connect(edges, "similar"), "id")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each group of near-duplicates stays."""
    return one_of_each(docs, classified(docs))
