"""Toxicity: a weighted lexicon matched by an Aho-Corasick automaton over folded text.

Folding lower-cases, turns letters of other alphabets that look Latin into Latin ones, drops invisible
characters and reads digits and signs inside words as the letters they stand for. Lexicon entries are
whole words or word beginnings; their weights are log ratios of frequencies in labelled training rows.
Matches within an exception phrase don't count, and a word counts once. The summed weight, normalised by
a power of the text's length, goes through a logistic curve fitted on the same rows, that power included.

Defined results: null and empty texts score as a text without a match; texts are read whole; repeated
rows score alike; an empty table gives an empty result, and with no labelled rows every score is the
prior of a single toxic and a single clean row and an empty lexicon; extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from zlib import crc32

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leksika.llm.common import PREDICT_AT, in_tasks, judged, labelled_sample, pieces, remainder

# Letters that look like Latin ones, invisible characters, stand-ins, harmless phrases.
LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x",
    "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h", "ӏ": "l", "ԛ": "q", "ԝ": "w", "ь": "b", "г": "r", "п": "n",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ⅼ": "l", "ⅰ": "i", "ſ": "s",
}
INVISIBLE = "­͏​‌‍⁠﻿"
STAND_INS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}
EXCEPTIONS = ("class clown", "clown fish", "trash can", "trash bin", "trash talk", "pond scum")

FOLD = {ord(k): v for k, v in LOOKALIKES.items()} | {ord(c): None for c in INVISIBLE} | {0xFF41 + i: chr(97 + i) for i in range(26)} | {0xFF10 + i: chr(48 + i) for i in range(10)}
#: A word with stand-ins: it ends with a letter or digit, so that signs after it stay signs.
DISGUISED = re.compile(r"[^\W_@$]*[0134578@$](?:[\w@$]*[^\W_])?")
UNMASK = str.maketrans(STAND_INS)
MASKS = frozenset(STAND_INS)
WORD = re.compile(r"[^\W\d_]+")
#: Lengths of word beginnings that may become entries; least evidence (log likelihood ratio), purity and toxic documents of an entry.
STEMS, LEAST_G, LEAST_PURITY, LEAST_DOCUMENTS = (3, 4, 5, 6, 7, 8), 25.0, 0.5, 4
#: An entry's longer forms are preferred if they keep this share of its evidence.
KEPT_SHARE = 0.9


def fold(text: str) -> str:
    text = text.lower()
    if not text.isascii():
        text = text.translate(FOLD)
    if not MASKS.isdisjoint(text):
        text = DISGUISED.sub(unmasked, text)
    return text


def unmasked(found: re.Match) -> str:
    """A word of two letters or more with its stand-ins read as letters."""
    word = found[0]
    return word.translate(UNMASK) if sum(map(str.isalpha, word)) > 1 else word


def traits(text: str) -> tuple[list[str], list[int], int]:
    """A text's distinct folded words, the hashes of an eighth of its five-word shingles, and its own hash."""
    words = text.lower().split()
    marks = {h for h in (crc32(" ".join(words[j : j + 5]).encode()) for j in range(max(1, len(words) - 4))) if h % 8 == 0}
    return sorted(set(WORD.findall(fold(text)))), sorted(marks), xxhash.xxh64_intdigest(text) >> 1


def first_of_copies(marks: Iterable[list[int]], hashes: list[int]) -> list[int]:
    """Which texts stay if those go most of whose shingles an earlier one had: copies are no new evidence."""
    seen, kept, whole = set(), [], set()
    for i, (mine, text) in enumerate(zip(marks, hashes, strict=True)):
        if text in whole:
            continue
        whole.add(text)
        if not mine or 2 * sum(m in seen for m in mine) <= len(mine):
            kept.append(i)
        seen.update(mine)
    return kept


def learn_lexicon(words_of_texts: pa.ListArray, toxic: np.ndarray) -> dict[tuple[str, bool], float]:
    """(entry, whether it is a whole word) -> weight, from how many distinct words of toxic and of other texts have it."""
    coded = words_of_texts.flatten().dictionary_encode()
    distinct, codes = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
    text = np.repeat(np.arange(len(words_of_texts)), words_of_texts.value_lengths().to_numpy(zero_copy_only=False))
    bad = toxic[text] > 0
    n_bad, n_good = max(1, int(bad.sum())), max(1, int((~bad).sum()))
    share = n_bad / (n_bad + n_good)
    found: dict[tuple[str, bool], tuple[float, float]] = {}

    def judge(entries: pa.Array, of: np.ndarray, whole: bool) -> None:
        """Entries of which ``of`` says, for each word of each text, which it has (-1 for none)."""
        size, has = len(entries), of >= 0
        a, b = (np.bincount(of[has & side], minlength=size) for side in (bad, ~bad))
        # Toxic texts that have the entry, each once.
        pairs = np.unique(text[has & bad] * np.int64(max(1, size)) + of[has & bad])
        documents = np.bincount(pairs % max(1, size), minlength=size)
        purity = a / np.maximum(a + b, 1)
        for i in np.flatnonzero((documents >= LEAST_DOCUMENTS) & (purity > share) & (purity >= LEAST_PURITY)).tolist():
            g = 2 * (a[i] * np.log(purity[i] / share) + (b[i] * np.log((1 - purity[i]) / (1 - share)) if b[i] else 0))
            if g >= LEAST_G:
                found[entries[i].as_py(), whole] = float(g), float(np.log((a[i] + 0.5) / n_bad) - np.log((b[i] + 0.5) / n_good))

    judge(distinct, codes, True)
    for n in STEMS:
        long = pc.greater_equal(pc.utf8_length(distinct), n).to_numpy(zero_copy_only=False)
        stems = pc.utf8_slice_codeunits(distinct.filter(pa.array(long)), 0, n).dictionary_encode()
        stem_of = np.full(len(distinct), -1, np.int64)
        stem_of[long] = stems.indices.to_numpy(zero_copy_only=False)
        judge(stems.dictionary, stem_of[codes], False)
    # The best evidence first; of its family the whole word or longest beginning that is about as good; the rest of the family goes.
    kept, left = {}, sorted(found, key=lambda e: (-found[e][0], e))
    while left:
        top = left[0]
        family = [e for e in left if e[0].startswith(top[0]) or top[0].startswith(e[0])]
        close = [e for e in family if e[0].startswith(top[0]) and found[e][0] >= KEPT_SHARE * found[top][0]]
        best = max(close, key=lambda e: (e[1], len(e[0]), e[0]))
        kept[best] = found[best][1]
        gone = set(family)
        left = [e for e in left if e not in gone]
    return kept


def matcher(lexicon: dict[tuple[str, bool], float], exceptions: tuple[str, ...] = EXCEPTIONS) -> ahocorasick.Automaton:
    values: dict[str, list] = {}
    for (entry, whole), weight in lexicon.items():
        values.setdefault(entry, [None, None, False])[0 if whole else 1] = weight
    for phrase in exceptions:
        values.setdefault(phrase, [None, None, False])[2] = True
    automaton = ahocorasick.Automaton()
    for entry, value in values.items():
        automaton.add_word(entry, (len(entry), *value))
    automaton.make_automaton()
    return automaton


def weight_of(folded: str, automaton: ahocorasick.Automaton) -> float:
    """Summed weight of the distinct words that begin with or are an entry, outside exception phrases."""
    hits, excused = {}, []
    for end, (length, whole, stem, exception) in automaton.iter(folded):
        start = end - length + 1
        if start and folded[start - 1].isalpha():
            continue
        closed = end + 1 == len(folded) or not folded[end + 1].isalpha()
        if exception and closed:
            excused.append((start, end))
        weight = max(stem or 0.0, (whole or 0.0) if closed else 0.0)
        if weight:
            hits[start] = max(weight, hits.get(start, 0.0))
    words = {}
    for start, weight in hits.items():
        if not any(a <= start <= b for a, b in excused):
            words[WORD.match(folded, start)[0]] = weight
    return sum(words.values())


def evidence(folded: str, automaton: ahocorasick.Automaton) -> tuple[float, float]:
    """Logarithms of the summed weight and of the length; the curve's weight for the second normalises the first."""
    weight = weight_of(folded, automaton)
    return float(np.log1p(weight)), float(np.log(max(100, len(folded)) / 1000)) if weight else 0.0


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Intercept and slopes of a logistic curve, by Newton steps."""
    design = np.concatenate((np.ones((len(x), 1)), x), axis=1)
    beta, ridge = np.zeros(design.shape[1]), ridge * max(1, len(x))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        hessian = (design * (p * (1 - p))[:, None]).T @ design + ridge * np.eye(len(beta))
        beta = beta + np.clip(np.linalg.solve(hessian, design.T @ (y - p) - ridge * beta), -5, 5)
    return beta


class Toxicity:
    """A fitted model: small, pickled into tasks; the automaton is built once in each worker."""

    def __init__(self, lexicon: dict[tuple[str, bool], float], curve: np.ndarray, exceptions: tuple[str, ...] = EXCEPTIONS):
        self.lexicon, self.curve, self.exceptions, self._automaton = lexicon, curve, exceptions, None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_automaton": None}

    @property
    def automaton(self) -> ahocorasick.Automaton:
        if self._automaton is None:
            self._automaton = matcher(self.lexicon, self.exceptions)
        return self._automaton

    def evidence(self, texts: pa.Array) -> np.ndarray:
        return np.array([evidence(fold(t or ""), self.automaton) for t in texts.to_pylist()]).reshape(-1, 2)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.curve[0] + x @ self.curve[1:])))

    def __call__(self, texts: pa.Array) -> np.ndarray:
        return self.scores(self.evidence(texts))


def train(docs: DataFrame, labels: DataFrame) -> Toxicity:
    """Learn the lexicon from the words of a labelled sample, then the curve from what the lexicon finds in its whole texts."""
    sample = labelled_sample(docs, labels, "toxic", remainder(F.col("doc_id"), 4) != 2)

    def traits_of(part: pa.RecordBatch) -> pa.RecordBatch:
        words, marks, hashes = zip(*map(traits, part.column("text").to_pylist()), strict=True)
        return pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("label"), pa.array(words, pa.list_(pa.string())), pa.array(marks, pa.list_(pa.int64())), pa.array(hashes, pa.int64())], ["doc_id", "label", "words", "marks", "hash"])

    found = in_tasks(sample, traits_of, "doc_id long, label int, words array<string>, marks array<long>, hash long")
    kept = pa.array(first_of_copies((m.as_py() for m in found.column("marks")), found.column("hash").to_pylist()), pa.int64())
    found = found.select(["doc_id", "label", "words"]).take(kept)
    y = (found.column("label").to_numpy() > 0).astype(np.int64)
    model = Toxicity(learn_lexicon(found.column("words").combine_chunks(), y), np.zeros(3))

    def evidence_of(part: pa.RecordBatch) -> pa.RecordBatch:
        x = model.evidence(part.column("text"))
        return pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(x[:, 0]), pa.array(x[:, 1])], ["doc_id", "weight", "length"])

    weighed = in_tasks(sample, evidence_of, "doc_id long, weight double, length double")
    at = np.searchsorted(weighed.column("doc_id").to_numpy(), found.column("doc_id").to_numpy())
    x = np.stack((weighed.column("weight").to_numpy(), weighed.column("length").to_numpy()), axis=1)[at].reshape(-1, 2)
    # One toxic and one clean row more keep the curve defined when a class is missing.
    model.curve = fit_curve(np.concatenate((x, [(np.log1p(10.0), 0.0), (0.0, 0.0)])), np.append(y, (1, 0)))
    return model


def score_documents(docs: DataFrame, model: Toxicity) -> DataFrame:
    return judged(docs, model, remainder(F.col("doc_id"), 4) == 2)


def keep_clean(docs: DataFrame, model: Toxicity, at: float = PREDICT_AT) -> DataFrame:
    """The rows of ``docs`` whose text scores below ``at`` or has no match, all columns as they are: a lexicon that learned nothing rejects nothing."""

    def run(batches):
        for part in pieces(batches):
            x = model.evidence(part.column("text").cast(pa.string()))
            yield part.filter(pa.array((model.scores(x) < at) | (x[:, 0] <= 0)))

    return docs.mapInArrow(run, docs.schema)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the model, learned from ``labels`` of these documents, finds toxic go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return keep_clean(docs, train(docs, labels))
