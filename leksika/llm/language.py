"""Language ID by Bayesian evidence fusion.

The posterior of a page's or document's language is proportional to
  prior(host) * likelihood(text) * P(declared language | language).
Text likelihoods are those of character trigrams of words, learned from rows whose language is known,
tempered because neighbouring trigrams say the same twice. What the markup declares and how the address
ends are likelihood tables counted by grouped aggregation over all rows. The prior of a host is smoothed
towards its parent domain's, that towards its own parent's, up to the address suffix, whose prior is Bayes' rule
on the counts of all rows and P(suffix | language): the suffix is the root, so it counts once. Counts take a
row's language from its text alone, so declarations are judged by texts. Each key is counted by partial
aggregation, and keys that hold more than a thousandth of the rows are joined apart, by a broadcast of at most a
thousand of them, so a host that holds a third of all rows is no large group.

Every language is learned that has rows: its code is the primary subtag of ``lang``, two or three letters. A
language costs a megabyte of model and time in proportion.

Defined results: null text, empty host or null declaration is no evidence; hosts and sources are walked whole, however
long they are and however many domains they name; a text without letters, or with too little evidence (posterior below
``least``), is ``und``; texts and markup are read whole; repeated rows are counted as often as they stand; ties
go to the first language in order; an empty table gives an empty result; extra columns, whatever their names,
are carried by the stage and not read by the query.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from leksika.llm.common import BATCH_BYTES, Words, least_share, materialise, pieces, spread_join, sums_between

#: Distinct texts of a language that its model learns from at most, by hash.
TRAIN_ROWS = 400
BUCKETS, ALPHA = 1 << 18, 0.1
#: A text counts as this many independent trigrams at most: its evidence is a mean, tempered.
TEMPER = 60.0
#: Pseudo-rows by which a domain's prior leans on its parent's, and each table on an even one.
LEAN, EVEN = 20.0, 1.0
#: Below this posterior the language is undetermined.
LEAST = 0.5

#: Characters up to which a host or one of its domains is its own key; what is longer goes by a digest.
KEY = 253

LEFT_OUT = re.compile(r"(?i)<(script|style|nav|footer)\b")
HTML, LANG = re.compile(r"(?i)<html\b"), re.compile(r"""(?i)\blang\s*=\s*["']?([a-z]{2,3})\b""")


def grams(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the trigrams of each distinct word between marks, and the word of each. Letters only count."""
    texts = [b"<" + b"".join(re.findall(rb"[a-z\x80-\xff]+", w)) + b">" for w in words.distinct.to_pylist()]
    texts = [t if len(t) > 2 else b"" for t in texts]
    sizes = np.array([len(t) for t in texts], np.int64)
    raw = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    if len(raw) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    key = (raw[:-2] << np.uint64(16)) | (raw[1:-1] << np.uint64(8)) | raw[2:]
    inside = owner[:-2] == owner[2:]
    mixed = key[inside] * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(46)
    return mixed.astype(np.int64), owner[:-2][inside]


class TextModel:
    """Log likelihood of trigrams for each language, against the mean of all: gain in log10 for each trigram."""

    def __init__(self, languages: list[str], gains: np.ndarray, seen: np.ndarray):
        self.languages, self.gains, self.seen = languages, gains, seen

    @classmethod
    def of_counts(cls, languages: list[str], counts: np.ndarray) -> TextModel:
        """From how often each language has each trigram (languages, buckets)."""
        total = counts.sum(axis=1, keepdims=True, dtype=np.float64) + ALPHA * BUCKETS
        gains = np.empty(counts.shape, np.float32)
        for at in range(0, BUCKETS if languages else 0, 1 << 14):
            shares = (counts[:, at : at + (1 << 14)] + ALPHA) / total
            gains[:, at : at + (1 << 14)] = np.log10(shares) - np.log10(shares.mean(axis=0))
        return cls(languages, gains, counts.sum(axis=0) > 0)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each text: mean gain of each language, number of trigrams, share of trigrams ever seen."""
        words = Words(texts, lower=True)
        ids, owner = grams(words)
        n = len(words.distinct)
        size = sums_between(np.bincount(owner, minlength=n)[words.codes], words.starts, words.ends)
        known = sums_between(np.bincount(owner, self.seen[ids].astype(np.float64), n)[words.codes], words.starts, words.ends)
        total = np.stack([sums_between(np.bincount(owner, g[ids], n)[words.codes], words.starts, words.ends) for g in self.gains], axis=1)
        some = np.maximum(size, 1)
        return total / some[:, None], size, known / some


def primary(lang: Column) -> Column:
    """The primary subtag of a language tag: two or three letters; null for anything else."""
    return F.nullif(F.regexp_extract(F.lower(F.trim(lang.cast("string"))), "^([a-z]{2,3})(?:[-_].*)?$", 1), F.lit(""))


def learn_text(rows: DataFrame, text: str, lang: str, max_rows: int = TRAIN_ROWS) -> TextModel:
    """From at most ``max_rows`` distinct texts of each language, those with the smallest hashes; copies count once.

    Hashes are thinned before they are ordered, texts are fetched by hash, and trigrams are counted where the texts
    are, so neither the number of languages nor the length of a text makes a large task.
    """
    known = rows.select(F.col(text).cast("string").alias("text"), primary(F.col(lang)).alias("lang")).where("text is not null and lang is not null")
    hashed = known.select("lang", F.xxhash64("text").alias("h"))
    sizes = materialise(hashed.groupBy("lang").agg(F.approx_count_distinct("h", 0.02).alias("texts")), "languages")
    thinned = hashed.join(F.broadcast(sizes), "lang").where(F.shiftrightunsigned("h", 33) < least_share(F.col("texts"), max_rows)).select("lang", "h").distinct()
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.shiftrightunsigned("h", 1), "h"))
    taken = thinned.withColumn("place", place).where(F.col("place") <= max_rows).select(F.col("lang").alias("of"), "h")
    met = known.join(F.broadcast(taken), (F.col("lang") == F.col("of")) & (F.xxhash64("text") == F.col("h")))
    sample = materialise(met.groupBy("of", "h").agg(F.first("text").alias("text")), "texts").repartition(32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            words = Words(part.column("text"), lower=True)
            ids, owner = grams(words)
            order = np.argsort(owner, kind="stable")
            ids, at = ids[order], np.searchsorted(owner[order], np.arange(len(words.distinct) + 1))
            for lang, s, e in zip(part.column("of").to_pylist(), words.starts, words.ends, strict=True):
                times = np.bincount(words.codes[s:e], minlength=len(words.distinct))
                mine = np.bincount(ids, np.repeat(times, np.diff(at)), BUCKETS)
                some = np.flatnonzero(mine)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), pa.array(some, pa.int32()), pa.array(mine[some].astype(np.int64))], ["of", "bucket", "n"])

    summed = sample.mapInArrow(run, "of string, bucket int, n long").groupBy("of", "bucket").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(r.lang for r in sizes.collect())
    counts = np.zeros((len(languages), BUCKETS), np.float32)
    number = {lang: i for i, lang in enumerate(languages)}
    if summed.num_rows:
        coded = summed.column("of").combine_chunks().dictionary_encode()
        of = np.array([number[x] for x in coded.dictionary.to_pylist()])[coded.indices.to_numpy()]
        counts[of, summed.column("bucket").to_numpy()] = summed.column("n").to_numpy()
    return TextModel.of_counts(languages, counts)


def bare(html: str) -> str:
    """Text of markup, without scripts, styles, navigation and footers. One pass, whatever is left open."""
    out, at, searched = [], 0, set()

    def end_of(pattern: str, start: int) -> int:
        """Where the first match after ``start`` ends; a pattern that isn't found is not looked for again."""
        if pattern in searched:
            return -1
        found = re.compile(pattern, re.IGNORECASE).search(html, start)
        if found is None:
            searched.add(pattern)
            return -1
        return found.end()

    while True:
        start = html.find("<", at)
        if start < 0:
            break
        end, block = -1, LEFT_OUT.match(html, start)
        if block:
            end = end_of(rf"</{block[1].lower()}\s*>", block.end())
        elif html.startswith("<!--", start):
            end = end_of("-->", start + 4)
        if end < 0:
            end = end_of(">", start)
        if end < 0:
            break
        out.append(html[at:start])
        at = end
    return " ".join((*out, html[at:]))


def declared_in(html: str) -> str | None:
    """The language that the first ``html`` tag which names one does."""
    at = 0
    while tag := HTML.search(html, at):
        at = html.find(">", tag.end())
        at = len(html) if at < 0 else at
        if named := LANG.search(html, tag.end(), at):
            return named[1].lower()
    return None


def text_evidence(rows: DataFrame, model: TextModel, markup: bool, text: str = "text", keep: bool = False) -> DataFrame:
    """``rows`` (text, declared, host and others) with the text's log gains and, for markup, what it declares; with the text, if it is to ``keep``."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    out = T.StructType([f for f in rows.schema.fields if keep or f.name != text] + T._parse_datatype_string("gain array<double>, size long").fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for part in pieces(batches, text):
            texts, declared = part.column(text).cast(pa.string()), part.column("declared")
            if markup:
                html = [x or "" for x in texts.to_pylist()]
                declared = pa.array([declared_in(x) for x in html], pa.string())
                texts = pa.array([bare(x) for x in html], pa.string())
            gains, size, known = m(texts)
            size = np.where(known >= 0.5, size, 0)  # what looks like no language that was learned is no evidence
            columns = dict(zip(part.schema.names, part.columns, strict=True)) | {"declared": declared}
            columns |= {"gain": pa.array(gains.tolist(), pa.list_(pa.float64())), "size": pa.array(size.astype(np.int64))}
            yield pa.RecordBatch.from_arrays([columns[f.name] for f in out.fields], out.names)

    return rows.mapInArrow(run, out)


def short(host: Column) -> Column:
    """A host as a key of bounded length."""
    return F.when(F.length(host) <= KEY, host).otherwise(F.concat(F.lit("#"), F.sha2(host, 256)))


def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """host (its key), level, domain, root for each host and parent domain, the host itself at level 0.

    The key of a domain of up to ``KEY`` characters is the domain; that of a longer one is a digest of its first label and
    the key below, so a host of any number of labels costs time and room in proportion to its length.
    """
    names, size = ("host", "level", "domain", "root"), 0
    out: list[tuple] = []
    for batch in batches:
        for key, host in zip(batch.column("key").to_pylist(), batch.column("host").to_pylist(), strict=True):
            labels, below, length = host.split("."), "", -1
            for level in range(len(labels) - 1, -1, -1):
                length += len(labels[level]) + 1
                name = labels[level] + ("." + below if level < len(labels) - 1 else "")
                below = name if length <= KEY else "#" + hashlib.sha256(name.encode()).hexdigest()
                out.append((key, level, below, level == len(labels) - 1))
                size += len(key) + len(below) + 16
                if size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pydict(dict(zip(names, zip(*out, strict=True), strict=True)))
                    out, size = [], 0
    if out:
        yield pa.RecordBatch.from_pydict(dict(zip(names, zip(*out, strict=True), strict=True)))


def counted(rows: DataFrame, key: str, languages: list[str]) -> DataFrame:
    """key, n: for each value of ``key`` its rows in each language, by the language the text speaks for."""
    sums = [F.sum((F.col("best") == i).cast("double")).alias(f"n{i}") for i in range(len(languages))]
    return rows.where(F.col(key).isNotNull() & F.col("best").isNotNull()).groupBy(key).agg(*sums).select(key, F.array(*[f"n{i}" for i in range(len(languages))]).alias("n"))


def fuse(rows: DataFrame, languages: list[str], least: float = LEAST) -> DataFrame:
    """``rows`` (declared, host, gain, size and others) -> the others, size, lang, posterior."""
    n = len(languages)
    others = [c for c in rows.columns if c not in ("declared", "host", "gain", "size")]
    weight = F.least(F.col("size").cast("double"), F.lit(TEMPER))
    evidence = F.transform("gain", lambda g: g * weight)
    rows = rows.withColumn("text_log", evidence).withColumn("best", F.when(F.col("size") > 0, F.array_position("text_log", F.array_max("text_log")) - 1))
    rows = materialise(rows.withColumn("host", F.when(F.col("host") != "", F.col("host"))).drop("gain"), "evidence")

    every = rows.where("best is not null").agg(*[F.sum((F.col("best") == i).cast("double")) for i in range(n)]).first()
    total = [float(x or 0) for x in every]
    overall = [(x + EVEN / n) / (sum(total) + EVEN) for x in total]
    numbers = lambda values: F.array(*[F.lit(float(x)) for x in values])
    add = lambda s, x: s + x

    def leaned(own: Column, base: Column) -> Column:
        size = F.aggregate(own, F.lit(0.0), add)
        return F.zip_with(own, base, lambda x, b: (x + LEAN * b) / (size + LEAN))

    def rooted(own: Column) -> Column:
        """Bayes' rule for an address suffix: P(language) * P(suffix | language), summing to one."""
        both = F.zip_with(F.zip_with(own, numbers(total), lambda x, t: (x + 0.5) / (t + 1.0)), numbers(overall), lambda a, b: a * b)
        return F.transform(both, lambda x: x / F.aggregate(both, F.lit(0.0), add))

    # Each host's prior from the counts of its suffix and domains, the suffix first; a domain never counted changes nothing.
    hosts = rows.where("host is not null").groupBy("host").agg(*[F.sum((F.col("best") == i).cast("double")).alias(f"n{i}") for i in range(n)])
    hosts = materialise(hosts.select(short(F.col("host")).alias("key"), "host", F.array(*[F.coalesce(f"n{i}", F.lit(0.0)) for i in range(n)]).alias("n")), "hosts")
    chains = materialise(hosts.select("key", "host").mapInArrow(chained, "host string, level long, domain string, root boolean"), "chains")
    held = spread_join(chains, hosts.where(F.aggregate("n", F.lit(0.0), add) > 0).select(F.col("key").alias("host"), "n"), "host", "n").where("n is not null")
    domains = held.groupBy("domain").agg(*[F.sum(F.get("n", F.lit(i))).alias(f"n{i}") for i in range(n)]).select("domain", F.array(*[f"n{i}" for i in range(n)]).alias("n"))
    steps = spread_join(chains, materialise(domains, "domains"), "domain", "n").where("n is not null")
    step = F.struct((-F.col("level")).alias("near"), "root", "n")
    rows = rows.withColumn("host", short(F.col("host")))
    walked = F.aggregate(F.array_sort("steps"), numbers(overall), lambda prior, s: F.when(s["root"], rooted(s["n"])).otherwise(leaned(s["n"], prior)))
    priors = materialise(steps.groupBy("host").agg(F.collect_list(step).alias("steps")).select("host", walked.alias("prior")), "priors")

    # log10 P(declared | language), with an even share for a value never met.
    said = counted(rows, "declared", languages)
    said = materialise(said.select("declared", F.zip_with("n", numbers(total), lambda x, t: F.log10((x + 0.5) / (t + 1.0))).alias("declared_log")), "declared")
    none = numbers([0.0] * n)
    joined = spread_join(spread_join(rows, priors, "host", "prior"), said, "declared", "declared_log")
    prior_log = F.transform(F.coalesce("prior", numbers(overall)), lambda p: F.log10(p))
    text_log = F.when(F.col("size") > 0, F.col("text_log")).otherwise(none)
    logs = F.zip_with(F.zip_with(prior_log, text_log, add), F.coalesce("declared_log", none), add)
    fused = joined.withColumn("logs", logs).withColumn("most", F.array_max("logs"))
    mass = F.aggregate("logs", F.lit(0.0), lambda s, x: s + F.pow(F.lit(10.0), x - F.col("most")))
    place = F.array_position("logs", F.col("most")).cast("int")
    name = F.element_at(F.array(*[F.lit(x) for x in languages]), place)
    spoken = (F.col("size") > 0) | F.col("declared_log").isNotNull()
    return fused.select(*others, "size", (1 / mass).alias("posterior"), name.alias("name"), spoken.alias("spoken")).select(
        *others, "size", F.when(F.col("spoken") & (F.col("posterior") >= least), F.col("name")).otherwise("und").alias("lang"), F.round("posterior", 9).alias("posterior")
    )


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[^:/?#]+://(?:[^@/?#]*@)?([^:/?#]*)", 1))


def identify_pages(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """page_id, lang, posterior of every page; text models are learned from ``docs`` (text, lang)."""
    model = learn_text(docs, "text", "lang")
    if not model.languages:
        return pages.select(F.col("page_id").cast("long").alias("page_id"), F.lit("und").alias("lang"), F.lit(0.0).alias("posterior"))
    rows = pages.select(
        F.col("page_id").cast("long").alias("key"), F.col("html").cast("string").alias("text"), F.lit(None).cast("string").alias("declared"), host_of(F.col("url")).alias("host")
    )
    return fuse(text_evidence(rows, model, markup=True), model.languages).select(F.col("key").alias("page_id"), "lang", "posterior")


def keep_identified(docs: DataFrame, model: TextModel) -> DataFrame:
    """The rows of ``docs`` (text, lang, source and others) whose evidence names a learned language, columns as they are.

    What ``lang`` declares is weighed by how the texts of all rows bear it out, and ``source`` stands for the host.
    A text without letters, or in words of no learned language, is rejected.
    """
    carried = [f"c{i}" for i in range(len(docs.columns))]
    of = dict(zip(docs.columns, carried, strict=True))
    source = F.lower(F.col(of["source"]).cast("string")) if "source" in of else F.lit(None).cast("string")
    rows = docs.toDF(*carried).select("*", primary(F.col(of["lang"])).alias("declared"), source.alias("host"))
    found = fuse(text_evidence(rows, model, markup=False, text=of["text"], keep=True), model.languages)
    return found.where("size > 0 and lang <> 'und'").select(*[F.col(c).alias(name) for name, c in of.items()])


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents whose language stays undetermined go."""
    model = learn_text(docs, "text", "lang")
    return keep_identified(docs, model) if model.languages else docs.where("false")
