"""LM scoring: an interpolated modified Kneser-Ney model of order two or three, counted in Spark.

First the words are counted: by buckets of their 64-bit hashes, each written to the shared folder as a sorted
hash array with counts and ids, frequent words having small ids, so that what follows packs well. Then tasks
count n-grams of ids in batches and send them on packed, so that what a batch repeats moves once.

Trigrams meet at their middle word: all of u v w and u v x are in the bucket of v, and so are all of u v w and
t v w, so the counts of trigrams, the contexts ``u v`` and the numbers of words before ``v w`` are complete
after one exchange. A word with more than its share of the tokens has its bucket split: once by the word
before, which keeps contexts whole, and once by the word after, which keeps pairs whole; only its trigrams
move twice. What pairs tell about single words goes on, packed again, to buckets of words. Each bucket is
written as sorted arrays of 64-bit hashes of n-grams with their counts: a count that is the usual one takes no
space, one below 256 a byte, any other 64 bits. Workers map these files into memory and look up a batch's
distinct words, pairs and trigrams in sorted order. Nothing is pruned or capped: the model grows with the corpus.

The model: P(w|uv) = (max(c(uvw) - D(c(uvw)), 0) + (D1 n1(uv) + D2 n2(uv) + D3 n3(uv)) P(w|v)) / c(uv), and so
on down with the numbers of words before ``v w`` and before ``w`` in place of counts, to an even share over all
words and one unknown. A text is begun by ``order - 1`` marks, which are not scored, and closed by an end,
which is.

Defined results: a null text counts as empty, which is the end alone; texts are read whole; repeated rows
are counted and scored each for itself; rows with a null id are scored and not learned from; without
training rows every word has an even share; an empty table gives an empty result; extra columns are not
read.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leksika.llm.common import Words, materialise, pieces, remainder, sums_between, work_path
from leksika.sources.blocks import Folder

ORDER = 3
#: Tokens that a task counts before it sends n-grams on; bytes of text for each bucket, which a task of some ten times
#: that memory adds up: with larger executors, larger buckets keep the packed pieces long.
FLUSH, BUCKET_BYTES = 2_500_000, 16 << 20
#: A word is split when it is the middle of more than this share of a bucket's tokens.
SPLIT_SHARE = 0.25
#: Files of a store that can't be mapped which a worker holds at once.
HELD_FILES = 32
END = np.uint64(xxhash.xxh64_intdigest(b"\n"))  # no word has white space
BEGIN, UNKNOWN, FIRST = 0, 1, 2  # ids; words' ids begin with the third
#: Tables: values for each key, and what they are most often.
USUAL = {"trigram": (1,), "context": (2, 2, 0, 0), "pair": (1,), "word": (1, 1, 0, 0, 1)}
#: What is sent on: n-grams of both roles, for contexts only, for pairs only.
BOTH, CONTEXTS, PAIRS = 0, 1, 2
ZSTD = pa.Codec("zstd", compression_level=1)


def mixed(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """64-bit hash of a pair of numbers."""
    h = (u * np.uint64(0x9E3779B97F4A7C15)) ^ (v * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(0x165667B19E3779F9))
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def key_of(grams: list[np.ndarray]) -> np.ndarray:
    key = grams[0]
    for column in grams[1:]:
        key = mixed(key, column)
    return key


def top(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The bucket of each hash: its highest bits."""
    return (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)


def met_at(middle: np.ndarray, side: np.ndarray, splits: np.ndarray, bits: int) -> np.ndarray:
    """The bucket of a middle word and, if it is split, of the word beside it."""
    return top(mixed(middle, mixed(side, side) % splits.astype(np.uint64)), bits)


def tokens(texts: pa.Array, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct words and END, all texts as places among them (one beyond is a BEGIN), and where each text begins."""
    words = Words(texts, lower=True)
    hashes = np.append(words.hashes(), END)
    n, sizes = len(texts), words.ends - words.starts
    at = np.concatenate(([0], np.cumsum(sizes + order)))
    out = np.full(at[-1], len(hashes), np.int64)
    out[at[1:] - 1] = len(hashes) - 1
    out[np.arange(len(words.codes)) + order * np.repeat(np.arange(n), sizes) + order - 1] = words.codes
    return hashes, out, at


def scored_places(at: np.ndarray, order: int) -> np.ndarray:
    """Places of all words and ends."""
    scored = np.ones(at[-1], bool)
    for k in range(order - 1):
        scored[at[:-1] + k] = False
    return np.flatnonzero(scored)


def packed(columns: list[np.ndarray]) -> bytes:
    """64-bit columns, byte plane by byte plane, compressed."""
    planes = [np.ascontiguousarray(c.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes() for c in columns]
    return ZSTD.compress(b"".join(planes), asbytes=True)


def unpacked(raw: bytes, n: int, columns: int) -> list[np.ndarray]:
    planes = np.frombuffer(ZSTD.decompress(raw, 8 * n * columns), np.uint8).reshape(columns, 8, n)
    return [np.ascontiguousarray(p.T).view("<u8").ravel() for p in planes]


def cuts(values: np.ndarray) -> list[tuple[int, int]]:
    """start, end of each run of equal values."""
    if not len(values):
        return []
    bounds = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
    return list(zip(bounds, bounds[1:], strict=False))


def starts_of(keys: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)


def summed(order_by: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct values of the first column, sorted, and the sums of the others over each."""
    order = np.argsort(order_by)
    keys = order_by[order]
    starts = starts_of(keys)
    return keys[starts], [np.add.reduceat(c[order].astype(np.int64), starts) if len(starts) else np.empty(0, np.int64) for c in columns]


def classes(counts: np.ndarray) -> list[np.ndarray]:
    """Counts, and which of them are one, two, three or more."""
    return [counts, counts == 1, counts == 2, counts >= 3]


def write_table(folder: Folder, name: str, bucket: int, keys: np.ndarray, values: list[np.ndarray]) -> None:
    """Sorted keys with their values, in three parts: the usual values, values of a byte, values of 64 bits."""
    rows = np.stack([v.astype(np.int64) for v in values], axis=1)
    usual = (rows == np.array(USUAL[name])).all(axis=1)
    small = ~usual & (rows < 256).all(axis=1)
    large = ~usual & ~small
    sizes = np.array([usual.sum(), small.sum(), large.sum()], "<u8")
    folder.write(f"{name}-{bucket}", [sizes, keys[usual], keys[small], keys[large], rows[large].astype("<u8"), rows[small].astype(np.uint8)])


class Model:
    """Where the model is and the numbers that its estimates need."""

    def __init__(self, folder: Folder, order: int, bits: int, stats: dict[str, int], limit: int):
        self.folder, self.order, self.bits, self.stats, self.limit = folder, order, bits, stats, limit
        self._files: OrderedDict[str, np.ndarray] = OrderedDict()

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_files": OrderedDict()}

    @staticmethod
    def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
        """D for counts of none, one, two, three or more; 0.5, 1, 1.5 stand in where the corpus is too small to tell."""
        y = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
        d = [1 - 2 * y * n2 / n1 if n1 and n2 else 0.5, 2 - 3 * y * n3 / n2 if n2 and n3 else 1.0, 3 - 4 * y * n4 / n3 if n3 and n4 else 1.5]
        return np.array([0.0, *(min(max(x, 0.05), k + 0.95) for k, x in enumerate(d))])

    def discounts_of(self, level: str) -> np.ndarray:
        return self.discounts(*(self.stats.get(f"{level}{k}", 0) for k in (1, 2, 3, 4)))

    def file(self, name: str) -> np.ndarray:
        if name in self._files:
            self._files.move_to_end(name)
            return self._files[name]
        self._files[name] = found = self.folder.map(name)
        if self.folder.local() is None and len(self._files) > HELD_FILES:
            self._files.popitem(last=False)
        return found

    def word_ids(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Id and count of each distinct word's hash."""
        ids, counts = np.full(len(hashes), UNKNOWN, np.uint64), np.zeros(len(hashes), np.int64)
        order = np.argsort(hashes)
        of = top(hashes[order], self.bits)
        for s, e in cuts(of):
            raw, mine = self.file(f"vocabulary-{of[s]}"), order[s:e]
            n = len(raw) // 24
            if n:
                have, number, times = raw.view("<u8").reshape(3, n)
                at = np.minimum(np.searchsorted(have, hashes[mine]), n - 1)
                hit = have[at] == hashes[mine]
                ids[mine[hit]], counts[mine[hit]] = number[at[hit]], times[at[hit]]
        return ids, counts

    def splits(self, counts: np.ndarray) -> np.ndarray:
        """In how many parts words of these counts are dealt."""
        return 1 + counts // self.limit

    def find(self, name: str, keys: np.ndarray, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether a table has each key, and the values (values, keys), zeros where it hasn't. Keys are looked up by bucket and in order."""
        usual = USUAL[name]
        out, found = np.zeros((len(usual), len(keys)), np.int64), np.zeros(len(keys), bool)
        order = np.argsort(buckets.astype(np.uint16) if self.bits <= 16 else buckets, kind="stable")
        of = buckets[order]
        for s, e in cuts(of):
            raw, mine = self.file(f"{name}-{of[s]}"), order[s:e]
            if not len(raw):
                continue
            mine = mine[np.argsort(keys[mine])]
            wanted = keys[mine]
            sizes = raw[:24].view("<u8").astype(np.int64).tolist()
            bounds = 24 + 8 * np.cumsum([0, *sizes])
            after = bounds[3] + 8 * sizes[2] * len(usual)
            values = (np.broadcast_to(np.array(usual, np.int64), (sizes[0], len(usual))), raw[after:].reshape(-1, len(usual)), raw[bounds[3] : after].view("<u8").reshape(-1, len(usual)))
            for begin, end, have in zip(bounds, bounds[1:], values, strict=False):
                part = raw[begin:end].view("<u8")
                if len(part):
                    at = np.minimum(np.searchsorted(part, wanted), len(part) - 1)
                    hit = part[at] == wanted
                    found[mine[hit]] = True
                    out[:, mine[hit]] = have[at[hit]].T
        return found, out

    def score(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For each text: tokens, known tokens, base score, score."""
        s = self.stats
        hashes, seq, at = tokens(texts, self.order)
        ids, counts = self.word_ids(hashes)
        ids, splits = np.append(ids, np.uint64(BEGIN)), self.splits(np.append(counts, s["docs"]))
        sorted_ids, first, of = np.unique(ids, return_index=True, return_inverse=True)
        have = self.find("word", sorted_ids, top(mixed(sorted_ids, sorted_ids), self.bits))[1][:, of].astype(np.float64)
        total, before = have[0], have[4]
        low, even = self.discounts_of("before"), 1.0 / (s["words"] + 1)
        spare = low[1] * s.get("before1", 0) + low[2] * s.get("before2", 0) + low[3] * (s["words"] - s.get("before1", 0) - s.get("before2", 0))
        p_word = (before - low[np.minimum(before, 3).astype(np.int64)] + spare * even) / s["pairs"] if s["pairs"] else np.full(len(ids), even)
        place = scored_places(at, self.order)
        w, v = seq[place], seq[place - 1]
        d = self.discounts_of("pair")
        if self.order == 2:
            buckets = top(mixed(ids[v], ids[w]), self.bits)
        else:
            buckets = met_at(ids[v], ids[w], splits[v], self.bits)
        known, (c,) = self.find("pair", key_of([ids[v], ids[w]]), buckets)
        p = self.interpolated(c, total[v], d[1] * have[1][v] + d[2] * have[2][v] + d[3] * have[3][v], p_word[w], d)
        if self.order == 3:
            u, d = seq[place - 2], self.discounts_of("trigram")
            buckets = met_at(ids[v], ids[u], splits[v], self.bits)
            before_last = key_of([ids[u], ids[v]])
            c = self.find("trigram", key_of([before_last, ids[w]]), buckets)[1][0]
            often, context = self.find("context", before_last, buckets)
            # A pair that was met is a context; one that is not among the frequent ones was followed once.
            met = np.full(len(seq), s["docs"] > 0)
            met[place] = known
            once = ~often & met[place - 1]
            context[:, once] = np.array([[1], [1], [0], [0]])
            p = self.interpolated(c, context[0], d[1] * context[1] + d[2] * context[2] + d[3] * context[3], p, d)
        base = np.log10((counts + 0.5) / (s["tokens"] + 0.5 * (s["words"] + 1)))
        first, last = np.searchsorted(place, at[:-1]), np.searchsorted(place, at[1:])
        return last - first, sums_between((counts > 0)[w].astype(np.int64), first, last), sums_between_exact(base[w], first, last), sums_between_exact(np.log10(np.maximum(p, 1e-300)), first, last)

    @staticmethod
    def interpolated(c: np.ndarray, total: np.ndarray, spare: np.ndarray, below: np.ndarray, d: np.ndarray) -> np.ndarray:
        kept = c - d[np.minimum(c, 3)]
        return np.where(total > 0, (kept + spare * below) / np.maximum(total, 1), below)


def sums_between_exact(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """As sums_between, each summed for itself: differences of long running sums lose digits."""
    return np.array([values[s:e].sum() for s, e in zip(starts.tolist(), ends.tolist(), strict=True)])


SENT = "bucket int, kind int, n long, data binary"
STAT = "stat string, value long"


def sent(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary())
    columns = zip(*rows, strict=True) if rows else ([], [], [], [])
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], ["bucket", "kind", "n", "data"])


def stats_of(found: dict[str, int]) -> pa.Table:
    return pa.table({"stat": pa.array(found, pa.string()), "value": pa.array(found.values(), pa.int64())})


def gathered(rows: pa.Table, kinds: tuple[int, ...], columns: int) -> list[np.ndarray]:
    """The columns of all that was sent to a bucket as one of ``kinds``."""
    parts = [unpacked(raw, n, columns) for kind, n, raw in zip(*(rows.column(x).to_pylist() for x in ("kind", "n", "data")), strict=True) if kind in kinds]
    return [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [np.empty(0, np.uint64)] * columns


def number_of(counts: np.ndarray, level: str) -> dict[str, int]:
    """How many counts are one to four: what discounts are taken from."""
    n = np.bincount(np.minimum(counts, 5), minlength=6)
    return {f"{level}{k}": int(n[k]) for k in (1, 2, 3, 4)}


def count_words(rows: DataFrame, folder: Folder, bits: int) -> dict[str, int]:
    """Write the vocabulary; its numbers of words and tokens."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def flush() -> pa.RecordBatch:
            keys, (times,) = summed(*(np.concatenate(x) for x in zip(*held, strict=True)))
            held.clear()
            of = top(keys, bits)
            return sent([(int(of[s]), BOTH, e - s, packed([keys[s:e], times[s:e]])) for s, e in cuts(of)])

        for part in pieces(batches):
            words = Words(part.column("text"), lower=True)
            held.append((np.append(words.hashes(), END), np.append(np.bincount(words.codes, minlength=len(words.distinct)), part.num_rows)))
            n += len(words.codes) + part.num_rows
            if n >= FLUSH:
                yield flush()
                n = 0
        if held:
            yield flush()

    def vocabulary(rows: pa.Table) -> pa.Table:
        bucket = rows.column("bucket")[0].as_py()
        keys, (times,) = summed(*gathered(rows, (BOTH,), 2))
        rank = np.empty(len(keys), np.uint64)
        rank[np.argsort(-times, kind="stable")] = np.arange(len(keys), dtype=np.uint64)
        folder.write(f"vocabulary-{bucket}", [keys, FIRST + (rank << np.uint64(bits)) + np.uint64(bucket), times.astype("<u8")])
        return stats_of({"words": len(keys), "tokens": int(times.sum())})

    counted = rows.mapInArrow(count, SENT).groupBy("bucket").applyInArrow(vocabulary, STAT)
    return dict(materialise(counted, "vocabulary").groupBy("stat").agg(F.sum("value")).collect())


def train(docs: DataFrame, fold: Column, order: int = ORDER) -> Model:
    """Count the texts of the rows (doc_id, text) where ``fold`` holds, and write the model to the shared folder."""
    if order not in (2, 3):
        raise ValueError("the order is two or three")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).where(fold).select("text")
    n_docs, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()
    bits = max(0, int(np.ceil(np.log2(max(1, size / BUCKET_BYTES)))))
    folder = Folder(work_path(docs.sparkSession, "ngrams"))
    stats = {"docs": int(n_docs), "words": 0, "tokens": 0, "pairs": 0} | count_words(rows, folder, bits)
    model = Model(folder, order, bits, stats, max(1, int(SPLIT_SHARE * stats["tokens"] / 2**bits)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def flush() -> pa.RecordBatch:
            *grams, splits = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            keys = key_of(grams)
            order_ = np.argsort(keys)
            starts = starts_of(keys[order_])
            times = np.diff(np.append(starts, len(keys)))
            first = order_[starts]
            grams, splits = [g[first] for g in grams], splits[first]
            if order == 2:
                bucket, kind, row = top(keys[first], bits), np.zeros(len(first), np.int64), np.arange(len(first))
            else:
                u, v, w = grams
                own, other = met_at(v, u, splits, bits), met_at(v, w, splits, bits)
                apart = np.flatnonzero(own != other)
                bucket, row = np.concatenate((own, other[apart])), np.concatenate((np.arange(len(first)), apart))
                kind = np.concatenate((np.where(own != other, CONTEXTS, BOTH), np.full(len(apart), PAIRS)))
            to = (bucket * 3 + kind).astype(np.uint64)
            along = np.argsort((to << np.uint64(40)) | (grams[-2][row] & np.uint64((1 << 40) - 1)))  # the middle word in order packs best
            to, row = to[along], row[along]
            out = []
            for s, e in cuts(to):
                columns = [g[row[s:e]] for g in grams]
                out.append((int(to[s]) // 3, int(to[s]) % 3, e - s, packed(columns if to[s] % 3 == PAIRS else [*columns, times[row[s:e]]])))
            return sent(out)

        for part in pieces(batches):
            hashes, seq, at = tokens(part.column("text"), order)
            ids, counts = model.word_ids(hashes)
            ids, splits = np.append(ids, np.uint64(BEGIN)), model.splits(np.append(counts, stats["docs"]))
            place = scored_places(at, order)
            held.append((*(ids[seq[place - k]] for k in range(order - 1, -1, -1)), splits[seq[place - 1]]))
            n += len(place)
            if n >= FLUSH:
                yield flush()
                n = 0
        if held:
            yield flush()

    def met(rows: pa.Table) -> pa.Table:
        """A bucket's n-grams: trigrams and contexts, then pairs; what pairs tell about words goes on."""
        bucket, found = rows.column("bucket")[0].as_py(), {}
        if order == 3:
            u, v, w, c = gathered(rows, (BOTH, CONTEXTS), 4)
            keys = key_of([u, v, w])
            order_ = np.argsort(keys)
            starts = starts_of(keys[order_])
            c = np.add.reduceat(c[order_].astype(np.int64), starts) if len(starts) else np.empty(0, np.int64)
            first = order_[starts]
            write_table(folder, "trigram", bucket, keys[first], [c])
            found |= number_of(c, "trigram")
            contexts, values = summed(mixed(u[first], v[first]), *classes(c))
            often = values[0] > 1
            write_table(folder, "context", bucket, contexts[often], [x[often] for x in values])
            del u, v, w, c, keys, order_, first, contexts, values
            both, lone = gathered(rows, (BOTH,), 4)[:3], gathered(rows, (PAIRS,), 3)
            grams = [np.concatenate(x) for x in zip(both, lone, strict=True)]
            keys = key_of(grams)
            order_ = np.argsort(keys)
            first = order_[starts_of(keys[order_])]
            left, right = grams[1][first], grams[2][first]
            times = np.ones(len(first), np.int64)
        else:
            left, right, times = gathered(rows, (BOTH,), 3)
        keys = mixed(left, right)
        order_ = np.argsort(keys)
        starts = starts_of(keys[order_])
        times = np.add.reduceat(times[order_].astype(np.int64), starts) if len(starts) else np.empty(0, np.int64)
        first = order_[starts]
        left, right = left[first], right[first]
        write_table(folder, "pair", bucket, keys[first], [times])
        found |= number_of(times, "pair") | {"pairs": len(times)}
        out = []
        for kind, ids, values in ((0, *summed(left, *classes(times))), (1, *summed(right, np.ones(len(right), np.int64)))):
            of = top(mixed(ids, ids), bits)
            along = np.argsort(of, kind="stable")
            ids, values, of = ids[along], [x[along] for x in values], of[along]
            out += [(int(of[s]), kind, e - s, packed([ids[s:e], *(x[s:e] for x in values)])) for s, e in cuts(of)]
        out += [(-1, 2, value, name.encode()) for name, value in found.items()]
        return pa.Table.from_batches([sent(out)])

    def words(rows: pa.Table) -> pa.Table:
        bucket = rows.column("bucket")[0].as_py()
        contexts, nexts = gathered(rows, (0,), 5), gathered(rows, (1,), 2)
        none = np.zeros(len(nexts[0]), np.int64)
        fields = [np.concatenate((a.astype(np.int64), none)) for a in contexts[1:]] + [np.concatenate((np.zeros(len(contexts[0]), np.int64), nexts[1].astype(np.int64)))]
        ids, sums = summed(np.concatenate((contexts[0], nexts[0])), *fields)
        write_table(folder, "word", bucket, ids, sums)
        return stats_of(number_of(sums[4], "before"))

    partial = materialise(rows.mapInArrow(count, SENT).groupBy("bucket").applyInArrow(met, SENT), "of-words")
    numbers = partial.where("kind = 2").groupBy(F.decode("data", "UTF-8").alias("stat")).agg(F.sum("n").alias("value"))
    of_words = materialise(partial.where("kind < 2").groupBy("bucket").applyInArrow(words, STAT), "word-numbers").groupBy("stat").agg(F.sum("value").alias("value"))
    stats |= {r.stat: int(r.value) for r in numbers.unionAll(of_words).collect()}
    return Model(folder, order, bits, stats, model.limit)


def score_documents(docs: DataFrame, model: Model, held: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            n, known, base, score = model.score(part.column("text"))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n.astype(np.int64)), pa.array(known.astype(np.int64)), pa.array(base), pa.array(score)], ["doc_id", "n_tokens", "n_known", "base_score", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = rows.mapInArrow(run, "doc_id long, n_tokens long, n_known long, base_score double, score double")
    return scored.select(
        "doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "n_tokens", "n_known", F.lit(model.stats["tokens"]).cast("long").alias("train_tokens"),
        "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )


def perplexities(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """Learn from rows whose id's remainder by 5 is not 1 and score all."""
    model = train(docs, remainder(F.col("doc_id"), 5) != 1, order)
    return score_documents(docs, model, remainder(F.col("doc_id"), 5) == 1)
