"""Steps around runs on the driver: barriers, stores, lookups, dependencies."""

from __future__ import annotations

import re
import threading
import time
from abc import ABC, abstractmethod
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Protocol

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from leksika.operators import reviews as R
from leksika.operators.pointers import Log, Refused
from leksika.operators.retrieval import latest, nearest
from leksika.sources import sinks

# Phases at which a run can be held or failed, documents of a run, the form of a run's id, the longest key.
PHASES = ("before-write", "durable-write-before-ack", "checkpoint-before-cursor", "combined-transaction")
DOCUMENTS = ("status", "report", "checkpoint", "outcomes", "attempts")
RUN_ID, KEY_LENGTH = re.compile(r"checkpoint-[0-9a-f]{16,64}"), 256


class Injected(RuntimeError):
    """A fault that a test asked for."""


class Barriers:
    """ST07: a phase at which a run waits and then fails, for tests of what is durable by then."""

    def __init__(self, phase: str | None = None, hold: float = 0.0, sleep: Callable[[float], None] = time.sleep):
        if phase is not None and phase not in PHASES:
            raise Refused("invalid", f"unsupported phase {phase}; allowed: {', '.join(PHASES)}")
        if hold < 0:
            raise Refused("invalid", "a hold can't be negative")
        self.phase, self.hold, self.sleep = phase, hold, sleep

    @classmethod
    def of_request(cls, request: dict) -> Barriers:
        """The barrier that a request names as ``barrier`` or ``fault``."""
        return cls(request.get("barrier") or request.get("fault"), request.get("barrier_hold") or 0.0)

    def __call__(self, phase: str) -> None:
        if phase == self.phase:
            self.sleep(self.hold)
            raise Injected(phase)


def guarded(commit: Callable[[DataFrame, int], None], cursor: Callable[[int], None], barriers: Barriers) -> Callable[[DataFrame, int], None]:
    """ST02, ST07: a micro-batch's commit, then its cursor, with a barrier before, between and after."""

    def run(batch: DataFrame, number: int) -> None:
        barriers("before-write")
        commit(batch, number)
        barriers("durable-write-before-ack")
        barriers("checkpoint-before-cursor")
        cursor(number)
        barriers("combined-transaction")

    return run


def idempotency_key(value: object) -> str:
    """A key without white space at its ends, 1 to 256 characters and none of them a control character."""
    key = value.strip() if isinstance(value, str) else ""
    if not 1 <= len(key) <= KEY_LENGTH or any(ord(c) < 32 or 127 <= ord(c) < 160 for c in key):
        raise Refused("conflict", f"an idempotency key has 1 to {KEY_LENGTH} characters, none of them a control character")
    return key


def run_id_valid(c: Column) -> Column:
    """H09, H18 as a column."""
    return F.coalesce(c.rlike(f"^(?:{RUN_ID.pattern})$"), F.lit(False))


def references(run_id: str, root: str = "runs") -> dict[str, str]:
    """Where a run's documents are, relative to the state root."""
    return {"id": run_id, "run": f"{root}/{run_id}"} | {name: f"{root}/{run_id}/{name}.json" for name in DOCUMENTS}


def lease_diagnostics(lease: dict | None, now: float) -> dict:
    """H07, ST12: who holds a run, since when, and whether another may take it."""
    if lease is None:
        return {"owner": None, "operation": None, "generation": 0, "fence_token": None, "expiry": None, "heartbeat": None, "reclaimable": True}
    known = {name: lease.get(name) for name in ("owner", "operation", "generation", "fence_token", "expiry", "heartbeat", "ttl_seconds", "state")}
    return known | {"reclaimable": lease.get("expiry") is None or lease["expiry"] <= now}


class RunStore(Protocol):
    """Where a run's documents are kept."""

    def read(self, run_id: str, name: str) -> dict | None: ...

    def write(self, run_id: str, name: str, document: dict) -> None: ...


class MemoryRuns:
    """E04 in memory, for tests."""

    def __init__(self) -> None:
        self.documents: dict[tuple[str, str], dict] = {}

    def read(self, run_id: str, name: str) -> dict | None:
        return self.documents.get((run_id, name))

    def write(self, run_id: str, name: str, document: dict) -> None:
        self.documents[run_id, name] = dict(document)


class LoggedRuns:
    """E04, H15 in a folder: each document is a log of its revisions; two writers of one revision can't both succeed."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def _log(self, run_id: str, name: str) -> Log:
        return Log(self.spark, f"{self.root}/{run_id}/{name}")

    def read(self, run_id: str, name: str) -> dict | None:
        have = self._log(run_id, name).records()
        return have[-1] if have else None

    def write(self, run_id: str, name: str, document: dict) -> None:
        log = self._log(run_id, name)
        log.append(len(log.records()) + 1, document)


class Driver:
    """One run: executed once, read, and its reviews decided."""

    def __init__(self, run_id: str, store: RunStore):
        if not RUN_ID.fullmatch(run_id):
            raise Refused("not_found", f"{run_id} is no id of a run")
        self.run_id, self.store = run_id, store

    def execute(self, step: Callable[[], dict], barriers: Barriers | None = None) -> dict:
        """Run ``step``, which returns a report, unless the run is completed: then nothing is done."""
        status = self.store.read(self.run_id, "status") or {"status": "created", "revision": 0}
        if status["status"] == "completed":
            return self.result() | {"executed": False}
        barriers = barriers or Barriers()
        barriers("before-write")
        self.store.write(self.run_id, "status", {"status": "running", "revision": status["revision"] + 1})
        report = step()
        self.store.write(self.run_id, "report", report)
        barriers("durable-write-before-ack")
        self.store.write(self.run_id, "status", {"status": "completed", "revision": status["revision"] + 2})
        return self.result() | {"executed": True}

    def result(self) -> dict:
        status, report = (self.store.read(self.run_id, name) for name in ("status", "report"))
        if status is None:
            raise Refused("not_found", f"there is no run {self.run_id}")
        return {"run_id": self.run_id, "status": status["status"], "revision": status["revision"], "report": report}

    @staticmethod
    def review_queue(reviews: DataFrame, decisions: DataFrame) -> DataFrame:
        return R.queue(R.current(reviews, decisions))

    @staticmethod
    def review_read(reviews: DataFrame, decisions: DataFrame, review_id: str) -> dict:
        found = R.current(reviews.where(F.col("review_id") == review_id), decisions.where(F.col("review_id") == review_id)).take(1)
        if not found:
            raise Refused("not_found", f"there is no review {review_id}")
        return found[0].asDict()

    @staticmethod
    def review_decide(reviews: DataFrame, decision: DataFrame, path: str) -> int:
        """Append decisions (idempotency_key, hash and what ``decision_failure`` reads) that may be taken; the same ones again are no-ops."""
        judged = decision.join(reviews.select("review_id", "kind"), "review_id", "left").withColumn("failure", R.decision_failure())
        refused = judged.where("failure is not null or kind is null").take(1)
        if refused:
            raise Refused("invalid", f"{refused[0].review_id}: {refused[0].failure or 'no such review'}")
        return sinks.create_only(judged.drop("failure", "kind"), path, "idempotency_key")

    @staticmethod
    def candidate(evaluations: DataFrame, release: str) -> DataFrame:
        """A candidate's evaluations, in order of key and index."""
        return evaluations.where(F.col("release") == release).orderBy("stable_key", "selected_index")


_drivers: dict[tuple[str, str], Driver] = {}
_lock = threading.Lock()


def driver_for(run_id: str, root: str, make: Callable[[str], RunStore]) -> Driver:
    """The driver of a run under a root, made once."""
    with _lock:
        if (run_id, root) not in _drivers:
            _drivers[run_id, root] = Driver(run_id, make(root))
        return _drivers[run_id, root]


class EmbeddingStore(ABC):
    """Where vectors are kept and searched."""

    @abstractmethod
    def put(self, rows: DataFrame) -> int: ...

    @abstractmethod
    def find_nearest(self, query: Column, k: int, **options: object) -> DataFrame: ...

    @abstractmethod
    def get(self, vec_id: object) -> DataFrame: ...


class VectorTable(EmbeddingStore):
    """E02, H13 over a Parquet table (vec_id, embedding, hash and others)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def rows(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def put(self, rows: DataFrame) -> int:
        return sinks.create_only(rows, self.path, "vec_id")

    def find_nearest(self, query: Column, k: int, **options: object) -> DataFrame:
        return nearest(self.rows(), query, k, **options)

    def get(self, vec_id: object) -> DataFrame:
        return self.rows().where(F.col("vec_id") == vec_id)

    def count(self) -> int:
        return self.rows().count() if sinks.exists(self.spark, self.path) else 0

    def clear(self) -> bool:
        return sinks.remove(self.spark, self.path)


def by_id(entries: DataFrame, entry_id: str) -> DataFrame:
    """The entry of an id; the condition reaches the scan."""
    return entries.where(F.col("id") == entry_id)


def by_lema(entries: DataFrame, word: str) -> DataFrame:
    """The last entry written for a word, in any case, whatever its source."""
    return latest(entries.where(F.col("lema_lc") == word.strip().lower()))


def all_entries(entries: DataFrame) -> DataFrame:
    """Each word's last entry, in order."""
    return latest(entries).orderBy("lema_lc")


def observed_dimensions(rows: DataFrame, dimensions: int, column: str = "embedding") -> tuple[DataFrame, Observation]:
    """``rows`` as they are and, once they have been written, how many vectors (``wrong``) of how many (``seen``) have another length."""
    seen = Observation("dimensions")
    return rows.observe(seen, F.count("*").alias("seen"), F.count_if(~F.coalesce(F.size(column) == dimensions, F.lit(False))).alias("wrong")), seen


class Dependencies:
    """What operations are given, made on first use and replaced in tests."""

    def __init__(self, **make: Callable[[], object]):
        self._make, self._made, self._over = make, {}, {}

    def get(self, name: str) -> object:
        if name in self._over:
            return self._over[name]
        if name not in self._made:
            if name not in self._make:
                raise Refused("not_found", f"nothing provides {name}")
            self._made[name] = self._make[name]()
        return self._made[name]

    @contextmanager
    def overridden(self, **values: object) -> Iterator[None]:
        before, self._over = self._over, self._over | values
        try:
            yield
        finally:
            self._over = before

    def describe(self) -> dict:
        """The root document: a name and what can be asked for."""
        return {"name": "leksika", "provides": sorted(self._make)}


def refuse_canonical(path: str, canonical_root: str) -> None:
    """A projection is never written under the canonical entries."""
    at, root = (p.rstrip("/") + "/" for p in (path, canonical_root))
    if at.startswith(root):
        raise Refused("invalid", f"{path} is under the canonical entries")
