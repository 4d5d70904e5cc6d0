"""Embedding by a client: texts in Arrow batches to any model, with retries and one shape of answer."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import functions as F

Client = Callable[[list[str]], Sequence]


def values_of(answer: object) -> list[float]:
    """One vector, from a list, a mapping with ``values`` or ``embedding``, or an object that has one of these."""
    for name in ("values", "embedding"):
        inner = answer.get(name) if isinstance(answer, dict) else getattr(answer, name, None)
        if inner is not None and not callable(inner):
            return values_of(inner)
    return [float(x) for x in answer]


def ask(client: Client, texts: list[str], dimensions: int, max_retries: int = 3, sleep: Callable[[float], None] = time.sleep) -> list[list[float]]:
    """A vector for each text. A client that fails is asked again after min(0.5 * 2^n, 8) seconds; wrong numbers or lengths are an error at once."""
    for attempt in range(max_retries + 1):
        try:
            answers = client(texts)
            break
        except (OSError, TimeoutError):
            if attempt == max_retries:
                raise
            sleep(min(0.5 * 2**attempt, 8.0))
    vectors = [values_of(a) for a in answers]
    if len(vectors) != len(texts) or any(len(v) != dimensions for v in vectors):
        raise ValueError(f"expected {len(texts)} vectors of {dimensions}")
    return vectors


def embedding(make_client: Callable[[], Client], dimensions: int = 768, batch: int = 100):
    """A column function text -> array<double>; the client is made once in each task, null and blank texts have no vector."""

    @F.pandas_udf("array<double>")
    def run(columns: Iterator[pd.Series]) -> Iterator[pd.Series]:
        client = make_client()
        for texts in columns:
            out: list = [None] * len(texts)
            asked = [i for i, t in enumerate(texts) if t is not None and t.strip()]
            for at in range(0, len(asked), batch):
                some = asked[at : at + batch]
                for i, vector in zip(some, ask(client, [texts.iloc[i] for i in some], dimensions), strict=True):
                    out[i] = vector
            yield pd.Series(out)

    return run
