"""Best-fit packing after the Martello-Toth dominance reduction.

Lengths are whole numbers up to the sequence length, so the instance is a histogram with at most that
many bars, whatever the corpus: the driver reduces and packs the histogram, and no list of documents
leaves the executors. The reduction fixes a sequence {j}, {j, a} or {j, a, b} whenever it provably
dominates every other feasible sequence with j; best fit, longest first, packs the rest. Both work on
bars, whole multiples at a time. The plan says, for a run of ranks within a length, the sequences and
the place there; a document's rank is its rank in its own task plus the counts of the tasks before.

Defined results: a null text counts as empty and yields its closing id alone; a longer document is cut
into full pieces and a rest; repeated rows are packed each for itself; a null id is kept; an empty table
gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leksika.llm.common import Words, materialise, pieces

SEQUENCE, END_ID, TOKENIZER = 4096, 1, "word_bpe_49k.json"
#: Distinct words whose ids a Python worker keeps; words beyond are encoded again in each batch.
WORDS_KEPT = 500_000

PIECES = T.StructType([T.StructField(n, T.LongType() if n != "piece" else T.IntegerType()) for n in ("doc_id", "piece", "start", "length", "ids_crc32", "task", "local")])
_kept: dict[str, tuple] = {}


def tokenizer(name: str) -> tuple:
    """The tokenizer and the ids of words met so far, once for each worker."""
    if name not in _kept:
        import public_tokenizers
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _kept[name] = Tokenizer.from_file(public_tokenizers.path(name)), {}
    return _kept[name]


def word_ids(distinct: pa.Array, name: str) -> list[bytes]:
    """Little-endian 32-bit ids of each word.

    No token of this tokenizer crosses white space, which it drops, so a text's ids are its words' ids;
    a full stop or comma after a letter or digit is a token of its own, so it is looked up apart.
    """
    encoder, kept = tokenizer(name)
    words = distinct.to_pylist()
    stems = [w[:-1] if w[-1:] in (b".", b",") and w[-2:-1].isalnum() else w for w in words]
    found = {w: kept.get(w) for w in (*stems, b".", b",")}
    missing = [w for w, ids in found.items() if ids is None]
    for at in range(0, len(missing), 20_000):
        some = missing[at : at + 20_000]
        for w, coded in zip(some, encoder.encode_batch_fast([w.decode() for w in some], add_special_tokens=False), strict=True):
            found[w] = np.array(coded.ids, "<u4").tobytes()
            if len(kept) < WORDS_KEPT:
                kept[w] = found[w]
    ends = {46: found[b"."], 44: found[b","]}
    return [found[s] if len(s) == len(w) else found[s] + ends[w[-1]] for s, w in zip(stems, words, strict=True)]


def token_ids(column: pa.Array, name: str = TOKENIZER, end_id: int = END_ID) -> Iterator[np.ndarray]:
    """The ids of each text and its closing id."""
    # A-Z read as a-z, but for the names of special tokens.
    words = Words(column, lower=not pc.any(pc.match_substring(column, "<|")).as_py())
    coded = word_ids(words.distinct, name)
    sizes = np.array([len(x) // 4 for x in coded], np.int64)
    flat, at = np.frombuffer(b"".join(coded), "<u4"), np.concatenate(([0], np.cumsum(sizes)))
    for s, e in zip(words.starts, words.ends, strict=True):
        mine = words.codes[s:e]
        n = sizes[mine]
        total = int(n.sum())
        ids = np.empty(total + 1, "<u4")
        ids[total] = end_id
        if total:
            ids[:total] = flat[np.arange(total) + np.repeat(at[mine] - (np.cumsum(n) - n), n)]
        yield ids


def cut(docs: DataFrame, size: int = SEQUENCE, name: str = TOKENIZER) -> DataFrame:
    """One row per piece, with the task that made it and its rank among that task's pieces of its length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), np.zeros(size + 1, np.int64)
        for part in pieces(batches):
            rows = []
            for doc_id, ids in zip(part.column("doc_id").to_pylist(), token_ids(part.column("text"), name), strict=True):
                for k, start in enumerate(range(0, len(ids), size)):
                    own = ids[start : start + size]
                    rows.append((doc_id, k, start, len(own), zlib.crc32(own), task, int(seen[len(own)])))
                    seen[len(own)] += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if i != 1 else pa.int32()) for i, c in enumerate(zip(*rows, strict=True))], PIECES.names)

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return picked.mapInArrow(run, PIECES)


class Plan:
    """Sequences by kind: for a length, runs of ranks with their first sequence, how many share one, and the place there."""

    def __init__(self, size: int):
        self.size, self.kinds = size, []  # (how many sequences, [(length, copies), ...])

    def add(self, count: int, parts: list[tuple[int, int]]) -> None:
        self.kinds.append((count, parts))

    @property
    def sequences(self) -> int:
        return sum(count for count, _ in self.kinds)

    def runs(self) -> dict[str, np.ndarray]:
        rank: dict[int, int] = {}
        rows, base = [], 0
        for count, parts in self.kinds:
            offset = 0
            for length, copies in parts:
                first = rank.get(length, 0)
                rows.append((length, first, base, copies, offset))
                rank[length] = first + count * copies
                offset += length * copies
            base += count
        rows.sort()
        cols = np.array(rows, np.int64).reshape(-1, 5).T
        return dict(zip(("length", "rank", "sequence", "copies", "offset"), cols, strict=True))


def reduce_instance(counts: np.ndarray, plan: Plan) -> None:
    """Fix dominating sequences for good; ``counts[w]`` is left with the pieces that remain of length ``w``.

    For the longest left, j, with room r beside it, let a be the longest other that fits. With nothing that
    fits, {j} dominates. If a fills r, {j, a} does: all that could join j fits in a's place. If no two
    others fit, {j, a} does. If no three fit, let b be the longest that fits beside j and a: {j, a, b}
    does, unless two longer than b fit beside j and together are longer than a.
    """
    size = plan.size
    j = size
    while j:
        if not counts[j]:
            j -= 1
            continue
        if not fix(counts, plan, j):
            j -= 1


def fix(counts: np.ndarray, plan: Plan, j: int) -> bool:
    size = plan.size
    room = size - j
    counts[j] -= 1  # one j is placed; what follows looks at the others
    present = np.flatnonzero(counts[: room + 1])
    result: list[int] | None = None
    if not len(present):
        result = []
    else:
        a = int(present[-1])
        smallest = np.repeat(present[:3], np.minimum(counts[present[:3]], 3))[:3]
        if a == room or len(smallest) < 2 or smallest[0] + smallest[1] > room:
            result = [a]
        elif len(smallest) < 3 or smallest.sum() > room:
            counts[a] -= 1
            fits = np.flatnonzero(counts[: room - a + 1])
            counts[a] += 1
            b = int(fits[-1]) if len(fits) else 0
            ys = present[(present > b) & (present <= room // 2)]
            if len(ys):
                # The longest x that fits beside each y, at least as long as y; of equal lengths two are needed.
                xs = present[np.searchsorted(present, room - ys, "right") - 1]
                ok = (xs > ys) | ((xs == ys) & (counts[ys] > 1))
                beaten = bool((ok & (xs + ys > a)).any())
            else:
                beaten = False
            if not beaten:
                result = [a, b] if b else [a]
    counts[j] += 1
    if result is None:
        return False
    parts: dict[int, int] = {}
    for w in (j, *result):
        parts[w] = parts.get(w, 0) + 1
    times = min(int(counts[w]) // n for w, n in parts.items())
    # All but the last few of a kind may go at once: the others stay present, so the argument holds for each.
    for w, n in parts.items():
        counts[w] -= times * n
    plan.add(times, sorted(parts.items(), reverse=True))
    return True


def best_fit(counts: np.ndarray, plan: Plan) -> None:
    """Best fit, longest first; open sequences of one residue and make are one group."""
    size = plan.size
    groups: dict[int, list[tuple[int, list]]] = {}  # residue -> [(how many, parts)]
    residues = np.zeros(size + 1, bool)

    def put(residue: int, count: int, parts: list) -> None:
        if count:
            groups.setdefault(residue, []).append((count, parts))
            residues[residue] = True

    for length in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[length])
        while left:
            fits = np.flatnonzero(residues[length:])
            if len(fits):
                residue = length + int(fits[0])
                count, parts = groups[residue].pop()
                if not groups[residue]:
                    del groups[residue]
                    residues[residue] = False
            else:
                residue, parts = size, []
                count = -(-left // (size // length))
            each = residue // length
            full = min(count, left // each)
            put(residue - each * length, full, [*parts, (length, each)])
            left -= full * each
            rest = count - full
            if rest and left and left < each:
                put(residue - left * length, 1, [*parts, (length, left)])
                rest, left = rest - 1, 0
            if rest and (parts or left):
                put(residue, rest, parts)
        counts[length] = 0
    for same in groups.values():
        for count, parts in same:
            plan.add(count, parts)


def plan_histogram(histogram: dict[int, int], size: int = SEQUENCE) -> Plan:
    counts = np.zeros(size + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    plan = Plan(size)
    reduce_instance(counts, plan)
    best_fit(counts, plan)
    return plan


def pack(docs: DataFrame, size: int = SEQUENCE, name: str = TOKENIZER) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece.

    The plan is broadcast: its runs are bounded by the lengths, at most ``size`` of them, and by the
    groups that best fit makes of them, not by the documents.
    """
    cutted = materialise(cut(docs, size, name), "pieces")
    by_task = materialise(cutted.groupBy("task", "length").agg(F.count("*").alias("n")), "lengths")
    plan = plan_histogram({r.length: r.n for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}, size)
    runs = docs.sparkSession.sparkContext.broadcast(plan.runs())
    before = by_task.selectExpr("task", "length", "coalesce(sum(n) over (partition by length order by task rows between unbounded preceding and 1 preceding), 0) as before")
    # One row for each task and length: it grows with the tasks, so it is merged, not broadcast.
    ranked = cutted.join(before.hint("merge"), ["task", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("local") + F.col("before")).alias("rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = runs.value
        shift = np.int64(1 << 44)
        keys = r["length"] * shift + r["rank"]
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            at = np.searchsorted(keys, length * shift + rank, "right") - 1
            since, copies = rank - r["rank"][at], r["copies"][at]
            sequence, offset = r["sequence"][at] + since // copies, r["offset"][at] + since % copies * length
            columns = [batch.column(i) for i in range(5)] + [pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document that is left, packed."""
    return pack(docs)
