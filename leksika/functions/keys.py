"""Stable keys: Unicode NFKC and case folding, which Spark lacks, in Arrow batches."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_LENGTH = 256


def normalise(key: str | None) -> tuple[str | None, str | None]:
    """The key and, if it is none, why: keys are identifiers, never paths or URLs."""
    if key is None:
        return None, "missing"
    folded = unicodedata.normalize("NFKC", key)
    if any(unicodedata.category(c) in ("Cc", "Cf") for c in folded):
        return None, "control character"
    folded = " ".join(folded.split()).casefold()
    problem = (
        "blank" if not folded else "too long" if len(folded) > MAX_LENGTH
        else "url" if folded.startswith(("gs://", "http://", "https://"))
        else "path-like" if "/" in folded or "\\" in folded or ".." in folded or folded == "." else None
    )
    return (None, problem) if problem else (folded, None)


def stable_key(c: Column) -> Column:
    """struct(key, problem) of each value."""

    @F.pandas_udf("key string, problem string")
    def run(values: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([normalise(v) for v in values], columns=["key", "problem"])

    return run(c)
