"""corpus_pipeline.run() against plain Python, stage by stage and as a whole."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from leksika.llm import language, packing, toxicity
from leksika.llm.common import table


def clean_rows(rows, model):
    """Each text is judged alone."""
    return [r for r in rows if model(pa.array([r.text], pa.string()))[0] < 0.3]


def identified_rows(rows, model):
    """The fusion in plain numbers: likelihood of the text, of what lang declares, and the prior of the source."""
    n = len(model.languages)
    logs, best, declared = [], [], []
    for r in rows:
        gains, size, known = (x[0] for x in model(pa.array([r.text], pa.string())))
        size = int(size) if known >= 0.5 else 0
        logs.append(gains * min(size, language.TEMPER))
        best.append(int(np.argmax(logs[-1])) if size else None)
        declared.append(r.lang.lower() if r.lang else None)
    total = [sum(b == i for b in best) for i in range(n)]
    overall = np.array([(t + language.EVEN / n) / (sum(total) + language.EVEN) for t in total])

    def counts(values):
        out = defaultdict(lambda: np.zeros(n))
        for value, b in zip(values, best, strict=True):
            if value and b is not None:
                out[value][b] += 1
        return out

    said, sources = counts(declared), counts([r.source for r in rows])
    kept = []
    for r, log, b, d in zip(rows, logs, best, declared, strict=True):
        if b is None:
            continue
        prior = overall
        if r.source in sources:
            prior = overall * (sources[r.source] + 0.5) / (np.array(total) + 1)
            prior = prior / prior.sum()
        value = log + np.log10(prior)
        if d in said:
            value = value + np.log10((said[d] + 0.5) / (np.array(total) + 1))
        if 1 / (10 ** (value - value.max())).sum() >= language.LEAST:
            kept.append(r)
    return kept


def single_rows(rows):
    """All pairs: the smallest id of each class of five-word shingle sets with a similarity of 0.8."""

    def shingles(text):
        words = (text or "").encode().lower().split()
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    sets = [shingles(r.text) for r in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if min(len(a), len(b)) >= 0.8 * max(len(a), len(b)) and len(a & b) >= 0.8 * len(a | b) - 1e-9:
                x, y = sorted((root(i), root(j)))
                label[y] = x
    least = {}
    for i, r in enumerate(rows):
        least[root(i)] = min(least.get(root(i), r.doc_id), r.doc_id)
    return [r for i, r in enumerate(rows) if least[root(i)] == r.doc_id]


def test_run_is_what_plain_python_keeps_and_packs(spark, sf):
    import public_tokenizers
    from tokenizers import Tokenizer

    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    rows = clean_rows(docs.collect(), toxicity.train(docs, labels))
    clean = spark.createDataFrame(rows, docs.schema)
    rows = single_rows(identified_rows(rows, language.learn_text(clean, "text", "lang")))
    assert 0 < len(rows) < docs.count()
    encoder = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    expected, lengths = set(), []
    for r in rows:
        ids = [*encoder.encode(r.text or "", add_special_tokens=False).ids, packing.END_ID]
        for k, start in enumerate(range(0, len(ids), packing.SEQUENCE)):
            own = np.array(ids[start : start + packing.SEQUENCE], "<u4")
            lengths.append(len(own))
            expected.add((r.doc_id, k, start, len(own), zlib.crc32(own.tobytes())))
    found = corpus_pipeline.run(spark, sf).collect()
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found} == expected and len(found) == len(expected)
    used = Counter()
    for r in sorted(found, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == used[r.sequence_id]
        used[r.sequence_id] += r.length
    bound = max(-(-sum(lengths) // packing.SEQUENCE), sum(2 * x > packing.SEQUENCE for x in lengths))
    assert max(used.values()) <= packing.SEQUENCE and len(used) <= bound + max(1, bound // 50)


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None)], [(None, "", "en", "s", 0), (2, None, "en", "s", 0), (2, "12 34", "xx", None, 5)]])
def test_null_and_empty_documents(spark, sf, tmp_path, rows):
    """Nothing that has a language: no crash, and nothing is packed."""
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    table(spark, sf, "labels").write.parquet(f"{tmp_path}/labels.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path))
    assert found.count() == 0 and found.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
