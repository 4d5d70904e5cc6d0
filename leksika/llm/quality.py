"""Quality: supervised subword embeddings, averaged per document, with a softmax output.

Each word brings hashed vectors for itself, its character n-grams with word marks and its pair with the
word before it; a word that repeats the one before it, or a line that repeats an earlier line, has a
feature of its own. The document is the mean of these vectors. Vectors and output layer are learned by
mini-batch stochastic gradient descent in numpy. For scoring, the output layer is folded into the
vectors, so that each feature is one number, and a word is looked up once for each batch of texts.

Defined results: null and empty texts score by the bias alone; texts are read whole; repeated rows score
alike; an empty table gives an empty result; with no labelled rows every score is 0.5; extra columns are
not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leksika.llm.common import Words, in_tasks, judged, labelled_sample, remainder, sums_between

BUCKETS, DIM, GRAMS = 1 << 18, 8, (1, 3, 4)
EPOCHS, RATE, BATCH, TRAIN_ROWS = 4, 0.6, 32, 4000
#: The first buckets stand for: a repeated word, a repeated line, the document itself.
REPEAT, LINE, DOCUMENT, RESERVED = 0, 1, 2, 8
MIX = np.uint64(0x9E3779B97F4A7C15)


def buckets(hashes: np.ndarray) -> np.ndarray:
    mixed = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (RESERVED + (mixed >> np.uint64(33)) % np.uint64(BUCKETS - RESERVED)).astype(np.int64)


def word_features(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all distinct words' features, the word of each, and each word's hash.

    A word stands between marks; its n-grams are those of the marked bytes, and the whole is a feature.
    """
    raw, at = words.raw()
    n = len(at) - 1
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    sizes = np.diff(at)
    begins = at[:-1] + 2 * np.arange(n)
    marked = np.zeros(len(raw) + 2 * n, np.uint64)
    owner = np.repeat(np.arange(n), sizes + 2)
    inner = np.arange(len(raw)) + 2 * np.repeat(np.arange(n), sizes) + 1
    marked[inner] = raw
    marked[begins], marked[begins + sizes + 1] = 1, 2
    ids, owners = [], []
    for size in GRAMS:
        if len(marked) >= size:
            hashes = np.full(len(marked) - size + 1, size, np.uint64)
            for k in range(size):
                hashes = hashes * MIX + marked[k : len(marked) - size + 1 + k]
            inside = owner[: len(hashes)] == owner[size - 1 :]
            ids.append(buckets(hashes[inside]))
            owners.append(owner[: len(hashes)][inside])
    whole = words.hashes()
    ids.append(buckets(whole))
    owners.append(np.arange(n))
    return np.concatenate(ids), np.concatenate(owners), whole


def pair_features(words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of neighbouring words and, for each, whether both are in one text."""
    codes = words.codes
    a, b = hashes[codes[:-1]], hashes[codes[1:]]
    inside = np.ones(max(0, len(codes) - 1), bool)
    cuts = words.starts[(words.starts > 0) & (words.starts < len(codes))]
    inside[cuts - 1] = False
    return np.where(a == b, REPEAT, buckets(a * MIX + b)), inside


def repeated_lines(texts: pa.Array) -> np.ndarray:
    counts = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts.to_pylist()):
        lines = [x for x in text.split("\n") if x] if text else []
        counts[i] = len(lines) - len(set(lines))
    return counts


def document_features(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text its buckets and how often each occurs."""
    words, lines = Words(texts), repeated_lines(texts)
    ids, owners, hashes = word_features(words)
    order = np.argsort(owners, kind="stable")
    ids, at = ids[order], np.searchsorted(owners[order], np.arange(len(hashes) + 1))
    pairs, _ = pair_features(words, hashes)
    out = []
    for i, (s, e) in enumerate(zip(words.starts, words.ends, strict=True)):
        mine, times = np.unique(words.codes[s:e], return_counts=True)
        parts = [np.repeat(ids[at[w] : at[w + 1]], t) for w, t in zip(mine, times, strict=True)]
        parts += [pairs[s : max(s, e - 1)], np.array([DOCUMENT] + [LINE] * lines[i])]
        out.append(np.unique(np.concatenate(parts), return_counts=True))
    return out


def fit(features: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, seed: int = 7) -> tuple[np.ndarray, float]:
    """The folded weight of each bucket and the bias."""
    rng = np.random.default_rng(seed)
    vectors = (rng.random((BUCKETS, DIM), dtype=np.float32) - 0.5) / DIM
    output, bias = np.zeros((2, DIM), np.float32), np.zeros(2, np.float32)
    steps, total = 0, max(1, EPOCHS * -(-len(y) // BATCH))
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for at in range(0, len(y), BATCH):
            rows = order[at : at + BATCH]
            ids = np.concatenate([features[i][0] for i in rows])
            counts = np.concatenate([features[i][1] for i in rows]).astype(np.float32)
            sizes = np.array([len(features[i][0]) for i in rows])
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            share = counts / np.repeat(np.add.reduceat(counts, starts), sizes)
            mean = np.add.reduceat(vectors[ids] * share[:, None], starts, axis=0)
            logits = mean @ output.T + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(rows)), y[rows]] -= 1
            rate = RATE * (1 - steps / total)
            back = p @ output
            output -= rate * (p.T @ mean) / len(rows) * 4
            bias -= rate * p.mean(axis=0)
            np.add.at(vectors, ids, -rate * np.repeat(back, sizes, axis=0) * share[:, None])
            steps += 1
    return (vectors @ (output[1] - output[0])).astype(np.float32), float(bias[1] - bias[0])


class Quality:
    """A fitted model: one weight for each bucket, and the bias."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias

    @classmethod
    def learn(cls, features: pa.Table) -> Quality:
        """From label, ids (32-bit buckets) and times (how often each occurs) of each document."""
        y = (features.column("label").to_numpy() > 0).astype(np.int64)
        if not len(y):
            return cls(np.zeros(BUCKETS, np.float32), 0.0)
        ids, times = (features.column(c).combine_chunks() for c in ("ids", "times"))
        return cls(*fit([(np.frombuffer(i.as_buffer(), "<i4"), np.frombuffer(t.as_buffer(), "<f4")) for i, t in zip(ids, times, strict=True)], y))

    def __call__(self, texts: pa.Array) -> np.ndarray:
        words, lines = Words(texts), repeated_lines(texts)
        ids, owners, hashes = word_features(words)
        sums = np.bincount(owners, self.weights[ids], len(hashes))
        sizes = np.bincount(owners, minlength=len(hashes))
        pairs, inside = pair_features(words, hashes)
        starts, ends = words.starts, words.ends
        last = np.maximum(starts, ends - 1)
        total = sums_between(sums[words.codes], starts, ends) + sums_between(np.where(inside, self.weights[pairs], 0), starts, last)
        count = sums_between(sizes[words.codes], starts, ends) + (last - starts) + 1 + lines
        logits = (total + self.weights[DOCUMENT] + lines * self.weights[LINE]) / count + self.bias
        return 1 / (1 + np.exp(-np.clip(logits, -60, 60)))


def features_of(part: pa.RecordBatch) -> pa.RecordBatch:
    """doc_id, label, ids, times of each row: however long a text, it has ``BUCKETS`` features at most."""
    found = document_features(part.column("text"))
    ids, times = (pa.array([x[k].astype(t).tobytes() for x in found], pa.binary()) for k, t in ((0, "<i4"), (1, "<f4")))
    return pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("label"), ids, times], ["doc_id", "label", "ids", "times"])


def train(docs: DataFrame, labels: DataFrame) -> Quality:
    sample = labelled_sample(docs, labels, "quality", remainder(F.col("doc_id"), 5) != 0, TRAIN_ROWS)
    return Quality.learn(in_tasks(sample, features_of, "doc_id long, label int, ids binary, times binary"))


def score_documents(docs: DataFrame, model: Quality) -> DataFrame:
    return judged(docs, model, remainder(F.col("doc_id"), 5) == 0)
