"""Dictionary pages over HTTP: a rate-limited, retried fetch for each row, in batches."""

from __future__ import annotations

import hashlib
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from datetime import UTC, datetime

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leksika.functions.text import url_of

FETCHED = "lema string, url string, source_kind string, status int, attempts int, content binary, content_hash string, retrieved_at timestamp, error string"
# Requests a second by kind of source, for all tasks together, and how many may be under way at once.
RATES, CONCURRENT = {"official-live": 1.0, "fallback": 2.0, "gov-derived": 2.0}, 2


class TokenBucket:
    """ST08: at most ``rate`` permits a second, with bursts of ``burst``."""

    def __init__(self, rate: float, burst: int = 1, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.rate, self.burst, self.clock, self.sleep = rate, burst, clock, sleep
        self.tokens, self.at = float(burst), clock()

    def take(self) -> None:
        now = self.clock()
        self.tokens, self.at = min(self.burst, self.tokens + (now - self.at) * self.rate), now
        if self.tokens < 1:
            self.sleep((1 - self.tokens) / self.rate)
            self.tokens, self.at = 1.0, self.clock()
        self.tokens -= 1


def get(url: str, timeout: float) -> tuple[int, bytes, str | None]:
    """Status (0 without an answer), body and Retry-After."""
    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": "leksika"}), timeout=timeout) as answer:
            return answer.status, answer.read(), None
    except urllib.error.HTTPError as error:
        return error.code, b"", error.headers.get("Retry-After")
    except OSError:
        return 0, b"", None


def fetch_one(url: str, bucket: TokenBucket, max_retries: int, timeout: float, sleep: Callable[[float], None] = time.sleep) -> tuple[int, int, bytes]:
    """Status, attempts and body; 0, 429 and 5xx are tried again after min(0.5 * 2^n, 8) seconds or Retry-After, if longer."""
    for attempt in range(max_retries + 1):
        bucket.take()
        status, body, after = get(url, timeout)
        if not (status in (0, 429) or 500 <= status < 600) or attempt == max_retries:
            break
        asked = float(after) if after and after.replace(".", "", 1).isdigit() else 0.0
        sleep(max(min(0.5 * 2**attempt, 8.0), asked))
    return status, attempt + 1, body


def fetch(words: DataFrame, base_url: str, source_kind: str = "official-live", max_retries: int = 3, timeout: float = 10.0, tasks: int = 1) -> DataFrame:
    """S01, S02, ST08: ``words`` (lema) with their pages. Each of ``tasks`` tasks has one request under way and its share of the kind's rate, so all together keep to both limits."""
    if not 1 <= tasks <= CONCURRENT:
        raise ValueError(f"1 to {CONCURRENT} requests may be under way at once")
    urls = words.select("lema", url_of(base_url, F.col("lema")).alias("url")).repartition(tasks)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bucket = TokenBucket(RATES.get(source_kind, 1.0) / tasks)
        for frame in frames:
            rows = []
            for lema, url in zip(frame["lema"], frame["url"], strict=True):
                status, attempts, body = fetch_one(url, bucket, max_retries, timeout)
                good = 200 <= status < 300
                rows.append((lema, url, source_kind, status, attempts, body if good else None, hashlib.sha256(body).hexdigest() if good else None, datetime.now(UTC).replace(tzinfo=None), None if good else f"status {status}"))
            yield pd.DataFrame(rows, columns=[f.split()[0] for f in FETCHED.split(", ")])

    return urls.mapInPandas(run, FETCHED)
