"""LM scoring and SentencePiece against references; the pipeline against its stages."""

import math
import random
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from leksika.llm import ngrams, pieces, queries
from leksika.llm.common import table


def tokens(text):
    return (text or "").encode().lower().split()


def kneser_ney(texts, order):
    """Plain dictionaries for the same model: P(word | words before it), and counts of words."""
    levels, unigrams = [None] + [Counter() for _ in range(order)], Counter()
    for t in texts:
        seq = [b"\x00"] * (order - 1) + [*tokens(t), b"\x01"]
        levels[order].update(tuple(seq[i - order + 1 : i + 1]) for i in range(order - 1, len(seq)))
        unigrams.update(seq[order - 1 :])
    for n in range(order - 1, 0, -1):
        levels[n].update(gram[1:] for gram in levels[n + 1])  # each different word before counts once
    contexts = [None, *(defaultdict(Counter) for _ in range(order))]
    totals = [None, *(Counter() for _ in range(order))]
    discounts = [None]
    for n in range(1, order + 1):
        kinds = Counter(levels[n].values())
        discounts.append(ngrams.Model.discounts(kinds[1], kinds[2], kinds[3], kinds[4]))
        for gram, c in levels[n].items():
            totals[n][gram[:-1]] += c
            contexts[n][gram[:-1]][min(c, 3)] += 1

    def p(before, word):
        before = tuple(before)
        n = len(before) + 1
        below = p(before[1:], word) if n > 1 else 1 / (len(unigrams) + 1)
        if not totals[n][before]:
            return below
        c = levels[n][(*before, word)]
        return (c - discounts[n][min(c, 3)] + sum(discounts[n][k] * m for k, m in contexts[n][before].items()) * below) / totals[n][before]

    return p, unigrams


@pytest.mark.parametrize("order", [2, 3])
@pytest.mark.parametrize(("bucket", "share"), [(1 << 11, 0.25), (1 << 11, 1e-6), (1 << 25, 0.25)])
def test_scores_are_those_of_dictionaries(spark, order, bucket, share, monkeypatch):
    """In one bucket and in many, with a few words split and with all of them."""
    monkeypatch.setattr(ngrams, "BUCKET_BYTES", bucket)
    monkeypatch.setattr(ngrams, "FLUSH", 500)
    monkeypatch.setattr(ngrams, "SPLIT_SHARE", share)
    rng = random.Random(3)
    words = ["The", "the", "é", "É", "x\x0by", "end.", *"abcdefgh"]
    rows = [(None if i == 9 else i, " ".join(rng.choice(words) for _ in range(rng.choice((0, 1, 3, 30, 200)))), "clash") for i in range(150)]
    rows += [(400, None, "x"), (401, "", "x"), (3, rows[3][1], "x"), (402, "never seen words", "x"), (403, "w " * 20000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string").repartition(4)
    found = ngrams.perplexities(docs, order).collect()
    train = [t for i, t, _ in rows if i is not None and crc32(str(i).encode()) % 5 != 1]
    p, unigrams = kneser_ney(train, order)
    n, v = sum(unigrams.values()), len(unigrams)
    for before in ((b"the",), (b"the", b"a"), (b"unknown", b"the"), (b"w", b"w")):
        assert sum(p(before[1 - order :], w) for w in unigrams) + p(before[1 - order :], b"unknown") == pytest.approx(1)
    texts = defaultdict(list)
    for i, t, _ in rows:
        texts[i].append(t)
    assert len(found) == len(rows)
    for r in found:
        seq = [b"\x00"] * (order - 1) + [*tokens(texts[r.doc_id][0]), b"\x01"]
        words_of = seq[order - 1 :]
        assert r.held_out == (r.doc_id is not None and crc32(str(r.doc_id).encode()) % 5 == 1)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words_of), sum(unigrams[t] > 0 for t in words_of), n)
        assert r.base_score == pytest.approx(sum(math.log10((unigrams[t] + 0.5) / (n + 0.5 * (v + 1))) for t in words_of))
        assert r.score == pytest.approx(sum(math.log10(p(seq[i - order + 1 : i], seq[i])) for i in range(order - 1, len(seq))))


def test_values_of_any_size_are_kept(tmp_path):
    """The usual, a byte's and more than 32 bits, and a store told by one slash."""
    keys = np.array([3, 7, 9, 2**63], np.uint64)
    folder = ngrams.Folder(f"file:{tmp_path}")
    ngrams.write_table(folder, "trigram", 0, keys, [np.array([1, 200, 256, 2**40])])
    model = ngrams.Model(folder, 3, 0, {}, 1)
    found, values = model.find("trigram", np.array([3, 4, 7, 9, 2**63], np.uint64), np.zeros(5, np.int64))
    assert found.tolist() == [True, False, True, True, True] and values[0].tolist() == [1, 0, 200, 256, 2**40]
    assert ngrams.Folder("hdfs:/x").local() is None and ngrams.Folder("hdfs://h/x").local() is None
    assert {ngrams.Folder(u).local() for u in ("file:/x", "file:///x", "/x")} == {"/x"}


def test_model_beats_base_on_held_out_texts(spark):
    found = ngrams.perplexities(table(spark, "/root/testdata/sf0.01", "documents")).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert found[0] > found[1]


def test_no_training_rows_and_no_rows(spark):
    docs = spark.createDataFrame([(i, "a b") for i in range(40) if crc32(str(i).encode()) % 5 == 1], "doc_id long, text string")
    assert {r.n_known for r in ngrams.perplexities(docs).collect()} == {0}
    assert ngrams.perplexities(docs.where("false")).count() == 0


def samples():
    rng = random.Random(8)
    alphabet = ["a", "B", "é", "ß", " ", " ", "  ", "\n", "\t", "日", "本", "🙂", "▁", "0", "42", ".", ",", "\u0000", "<s>", "the ", "Über "]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(800)] + ["word " * 30000, "", " ", "   x"]


def test_ids_and_texts_are_those_of_the_library(spark):
    import public_tokenizers

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pieces.MODEL))
    texts = samples() + [r.text for r in table(spark, "/root/testdata/sf0.001", "documents").collect()]
    model = pieces.load()
    assert model.words is not None
    for text, ids, whole in zip(texts, model.encode_column(pa.array(texts)), model.encode(texts), strict=True):
        expected = library.encode(text)
        assert ids.tolist() == expected and whole.tolist() == expected
        assert model.decode([ids])[0] == library.decode(expected)


def message(*parts):
    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    raw = b""
    for number, value in parts:
        if isinstance(value, bytes):
            raw += varint(number << 3 | 2) + varint(len(value)) + value
        elif isinstance(value, float):
            raw += varint(number << 3 | 5) + np.float32(value).tobytes()
        else:
            raw += varint(number << 3) + varint(value)
    return raw


def test_unigram_model_with_squeezed_spaces():
    """A small unigram model written by hand, against the library."""
    vocabulary = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3), *[(f"<0x{i:02X}>", -20.0, 6) for i in range(256)]]
    vocabulary += [("▁", -2.0, 1), ("a", -3.0, 1), ("b", -3.5, 1), ("ab", -4.0, 1), ("▁a", -3.2, 1), ("▁ab", -5.0, 1), ("ba", -4.1, 1)]
    raw = b"".join(message((1, message((1, p.encode()), (2, s), (3, t)))) for p, s, t in vocabulary)
    raw += message((2, message((3, 1), (4, len(vocabulary)), (35, 1), (40, 0), (41, 1), (42, 2))), (3, message((1, b"identity"), (3, 1), (4, 1), (5, 1))))
    pieces.SentencePieces(raw).verify(raw, ("ab ba  aab", " a", "b  ", "aß", "a b ab", "x"))


def test_round_trip_and_odd_rows(spark):
    rows = [(1, None, 1), (2, "", 1), (None, "  two  spaces\n\t", 1), (4, "x " * 50000, 1), (4, "x " * 50000, 1), (5, "日本🙂 é", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    found = pieces.digests(docs).collect()
    assert len(found) == len(rows) and all(r.round_trip for r in found)
    encoded = pieces.encode_documents(docs)
    decoded = {r.doc_id: r.text for r in pieces.decode_documents(encoded).collect()}
    assert decoded == {i: t or "" for i, t, _ in rows}
    assert pieces.digests(docs.where("false")).count() == 0
    assert {r.doc_id: len(r.ids) for r in encoded.collect()} == {r.doc_id: r.n_ids for r in found}


def test_pipeline_is_its_stages(spark, sf):
    docs = table(spark, sf, "documents")
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, sf)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == names and docs.join(before, "doc_id", "left_anti").count() == 0
    packed = corpus_pipeline.run(spark, sf)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "language_id", "simhash_near_dedup", "best_fit_packing"]
    columns = ["doc_id", "piece", "length", "ids_crc32"]
    assert packed.select(columns).exceptAll(docs.select(columns)).count() == 0 and packed.count() == docs.count()
    labels = table(spark, sf, "labels")
    left = packed.select("doc_id").distinct()
    clean = labels.where("toxic = 0")
    assert left.join(clean, "doc_id").count() >= 0.8 * clean.count()  # copies go, clean documents stay
    # One of each group of equal texts stays.
    texts = table(spark, sf, "documents").join(left, "doc_id").groupBy("text").count().where("count > 1")
    assert texts.count() == 0


def test_every_query_runs_whole_tables(spark, sf):
    sizes = {"op2_url_filter": "pages", "op5_language_id": "pages", "op4_quality_classifier": "documents", "op6_sentencepiece": "documents", "op7_simhash_near_dedup": "documents", "op8_toxicity": "documents", "op10_lm_scoring": "documents"}
    for name, source in sizes.items():
        assert queries.QUERIES[name](spark, sf).count() == table(spark, sf, source).count()
