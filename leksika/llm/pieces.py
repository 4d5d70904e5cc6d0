"""SentencePiece models on the backend of the tokenizers library.

The model's protobuf is parsed here: pieces, scores and types, the kind of model, byte fallback and the
normaliser. From it a tokenizer is built: the normaliser with its character map, the metaspace marker,
unigram scores or, for a BPE model, merges in the order of scores, and byte fallback. Batches are encoded
multithreaded. Where no piece goes on past a marker, a text is encoded by its words, each distinct word
once. When a worker loads a model, its ids are held against those of the sentencepiece library.

Defined results: null and empty texts have no ids; texts are read whole; repeated rows are encoded each
for itself; a null id is kept; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers

from leksika.llm.common import pieces

MODEL = "piece_bpe_32k.model"
MARK = "▁"
#: Piece types of the format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
PROBES = (
    "", " ", "a", "  two  spaces ", "Hello, world! 123", "tabs\tand\nlines", "Éçouç über señal ñandú", "日本語 テキスト", "emoji 🙂🙃 x",
    "\u0000\u0001 control", "▁marked ▁", "<s> </s> <unk> <0x41>", "ab" * 40, "x    y     z", "naïve café ﬁ Ⅷ",
)
#: Distinct words whose ids a Python worker keeps.
WORDS_KEPT = 300_000
_loaded: dict[str, SentencePieces] = {}


def fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        key = varint()
        number, kind = key >> 3, key & 7
        if kind == 0:
            yield number, varint()
        elif kind in (1, 5):
            width = 8 if kind == 1 else 4
            yield number, raw[at : at + width]
            at += width
        elif kind == 2:
            width = varint()
            yield number, raw[at : at + width]
            at += width
        else:
            raise ValueError(f"wire type {kind} is not part of the format")


class Parsed:
    """What a model file says."""

    def __init__(self, raw: bytes):
        self.vocabulary: list[tuple[str, float, int]] = []
        self.kind, self.byte_fallback, self.unk_id, self.suffix_mark = 1, False, 0, False
        self.charsmap, self.dummy_prefix, self.squeeze, self.escape = b"", True, True, True
        for number, value in fields(raw):
            if number == 1:
                piece, score, kind = "", 0.0, NORMAL
                for n, v in fields(value):
                    if n == 1:
                        piece = v.decode()
                    elif n == 2:
                        score = struct.unpack("<f", v)[0]
                    elif n == 3:
                        kind = v
                self.vocabulary.append((piece, score, kind))
            elif number == 2:
                trainer = dict(fields(value))
                self.kind, self.byte_fallback = trainer.get(3, 1), bool(trainer.get(35, 0))
                self.unk_id, self.suffix_mark = trainer.get(40, 0), bool(trainer.get(24, 0))
            elif number == 3:
                spec = dict(fields(value))
                self.charsmap = spec.get(2, b"")
                self.dummy_prefix, self.squeeze, self.escape = (bool(spec.get(n, 1)) for n in (3, 4, 5))
        if self.kind not in (1, 2):
            raise ValueError("only unigram and BPE models have a counterpart")
        if self.suffix_mark or not self.escape:
            raise ValueError("the marker must be a prefix")

    def model(self) -> models.Model:
        unk = self.vocabulary[self.unk_id][0]
        if self.kind == 1:
            return models.Unigram([(p, s) for p, s, _ in self.vocabulary], unk_id=self.unk_id, byte_fallback=self.byte_fallback)
        ids = {p: i for i, (p, _, _) in enumerate(self.vocabulary)}
        usable = {p for p, _, kind in self.vocabulary if kind in (NORMAL, USER_DEFINED)}
        merges = []
        for piece, score, kind in self.vocabulary:
            if kind == NORMAL and len(piece) > 1:
                halves = [(piece[:i], piece[i:]) for i in range(1, len(piece)) if piece[:i] in usable and piece[i:] in usable]
                merges += [(-score, ids[piece], ids[a], ids[b], (a, b)) for a, b in halves]
        merges.sort(key=lambda m: m[:4])
        return models.BPE({p: i for p, i in ids.items()}, [m[4] for m in merges], unk_token=unk, fuse_unk=True, byte_fallback=self.byte_fallback)

    def by_words(self) -> bool:
        """Whether words can be encoded apart: no piece holds a marker after another character, and nothing but markers is normalised."""
        inner = any(MARK in piece.lstrip(MARK) for piece, _, _ in self.vocabulary)
        return not inner and not self.charsmap and not self.squeeze and self.kind == 2 and not any(k == USER_DEFINED for _, _, k in self.vocabulary)


class SentencePieces:
    def __init__(self, raw: bytes):
        self.parsed = Parsed(raw)
        steps: list = [normalizers.Precompiled(self.parsed.charsmap)] if self.parsed.charsmap else []
        if self.parsed.squeeze:
            steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
        mark = normalizers.Replace(" ", MARK)
        self.whole = Tokenizer(self.parsed.model())
        self.whole.normalizer = normalizers.Sequence([*steps, *([normalizers.Prepend(MARK)] if self.parsed.dummy_prefix else []), mark])
        added = [AddedToken(p, normalized=False) for p, _, kind in self.parsed.vocabulary if kind == USER_DEFINED]
        if added:
            self.whole.add_tokens(added)
        self.whole.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), decoders.Strip(" ", 1 if self.parsed.dummy_prefix else 0, 0)])
        self.words = Tokenizer(self.parsed.model()) if self.parsed.by_words() else None
        if self.words:
            self.words.normalizer = mark
        self._kept: dict[bytes, bytes] = {}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, multithreaded."""
        return [np.array(e.ids, "<u4") for e in self.whole.encode_batch_fast(texts, add_special_tokens=False)]

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        return self.whole.decode_batch([i.tolist() for i in ids], skip_special_tokens=False)

    def encode_column(self, column: pa.Array) -> list[np.ndarray]:
        """Ids of each text of an Arrow column; each distinct word is encoded once."""
        column = pc.fill_null(column.cast(pa.large_string()), "")
        texts = column.to_pylist()
        apart = [self.words is not None and MARK not in t and t != "" for t in texts]
        out: list[np.ndarray] = [np.empty(0, "<u4")] * len(texts)
        others = [i for i, a in enumerate(apart) if not a and texts[i]]
        for i, ids in zip(others, self.encode([texts[i] for i in others]), strict=True):
            out[i] = ids
        mine = [i for i, a in enumerate(apart) if a]
        if not mine:
            return out
        prefix = b" " if self.parsed.dummy_prefix else b""
        raws = [prefix + texts[i].encode() for i in mine]
        data = np.frombuffer(b"".join(raws), np.uint8)
        ends = np.concatenate(([0], np.cumsum([len(r) for r in raws])))
        space = data == 32
        begins = space.copy()
        begins[1:] &= ~space[:-1]
        begins[ends[:-1]] = True
        at = np.flatnonzero(begins)
        units = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(np.append(at, len(data)).astype(np.int64)), pa.py_buffer(data)]).dictionary_encode()
        codes = units.indices.to_numpy(zero_copy_only=False)
        distinct = units.dictionary.to_pylist()
        found = [self._kept.get(w) for w in distinct]
        missing = [i for i, f in enumerate(found) if f is None]
        for s in range(0, len(missing), 20_000):
            some = missing[s : s + 20_000]
            for i, coded in zip(some, self.words.encode_batch_fast([distinct[i].decode() for i in some], add_special_tokens=False), strict=True):
                found[i] = np.array(coded.ids, "<u4").tobytes()
                if len(self._kept) < WORDS_KEPT:
                    self._kept[distinct[i]] = found[i]
        sizes = np.array([len(f) // 4 for f in found], np.int64)
        flat, starts = np.frombuffer(b"".join(found), "<u4"), np.concatenate(([0], np.cumsum(sizes)))
        bounds = np.searchsorted(at, ends)
        for i, s, e in zip(mine, bounds[:-1], bounds[1:], strict=True):
            own = codes[s:e]
            n = sizes[own]
            out[i] = flat[np.arange(n.sum()) + np.repeat(starts[own] - (np.cumsum(n) - n), n)]
        return out

    def verify(self, raw: bytes, texts: tuple[str, ...] = PROBES) -> None:
        """Ids and decoded texts as the sentencepiece library has them, or an error."""
        import sentencepiece

        other = sentencepiece.SentencePieceProcessor(model_proto=raw)
        mine = self.encode_column(pa.array(texts, pa.string()))
        for text, ids, whole in zip(texts, mine, self.encode(list(texts)), strict=True):
            expected = other.encode(text)
            if ids.tolist() != expected or whole.tolist() != expected or self.decode([ids])[0] != other.decode(expected):
                raise ValueError(f"no parity on {text!r}: {ids.tolist()} and {expected}")


def load(name: str = MODEL) -> SentencePieces:
    """The model of that name, once for each worker, verified."""
    if name not in _loaded:
        import public_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        os.environ.setdefault("RAYON_NUM_THREADS", "2")
        with open(public_tokenizers.path(name), "rb") as held:
            raw = held.read()
        model = SentencePieces(raw)
        model.verify(raw)
        _loaded[name] = model
    return _loaded[name]


def encode_documents(docs: DataFrame, name: str = MODEL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(name)
        for part in pieces(batches):
            ids = [i.astype(np.int32) for i in model.encode_column(part.column("text"))]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, name: str = MODEL) -> DataFrame:
    """doc_id, text of every row of doc_id, ids; null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(name)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                texts = model.decode([np.array(i or [], "<u4") for i in part.column("ids").to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")).mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, name: str = MODEL) -> DataFrame:
    """doc_id, n_ids, ids_crc32, decoded_crc32, round_trip: every text encoded and decoded again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(name)
        for part in pieces(batches):
            ids = model.encode_column(part.column("text"))
            decoded = model.decode(ids)
            columns = [
                part.column("doc_id"), pa.array([len(i) for i in ids], pa.int64()), pa.array([zlib.crc32(i.tobytes()) for i in ids], pa.int64()),
                pa.array([zlib.crc32(d.encode()) for d in decoded], pa.int64()), pa.array([d == (t or "") for d, t in zip(decoded, part.column("text").to_pylist(), strict=True)]),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_ids", "ids_crc32", "decoded_crc32", "round_trip"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_ids long, ids_crc32 long, decoded_crc32 long, round_trip boolean")
