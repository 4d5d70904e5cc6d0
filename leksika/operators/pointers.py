"""Driver steps: the current release by compare-and-swap, audit, idempotency, selectors.

State is a folder of numbered JSON files. A step creates the file of the next number, which fails if another
writer has done so: that is the swap. Nothing is ever rewritten, so the folder is the history and the audit.
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

# Tracks with their schemas, and codes of refusals.
SCHEMAS = {"word": "word-v1", "relations": "relations-v1"}
GENERATOR = "proj-gen-v1"
CODES = {"not_found": 404, "conflict": 409, "verification_failed": 422, "approval_required": 422, "invalid": 400}


class Refused(ValueError):
    """A step that was not taken: ``kind`` says why, ``status`` is its code."""

    def __init__(self, kind: str, message: str):
        super().__init__(message)
        self.kind, self.status = kind, CODES[kind]

    def to_dict(self) -> dict:
        """What an answer says."""
        return {"error": self.kind, "status": self.status, "message": str(self)}


class Log:
    """Numbered JSON records in a folder of any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        root = spark._jvm.org.apache.hadoop.fs.Path(path)
        self.fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
        self.fs.mkdirs(root)

    def _at(self, number: int):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{number:012d}.json")

    def records(self) -> list[dict]:
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        names = sorted(s.getPath().getName() for s in self.fs.listStatus(root) if s.getPath().getName().endswith(".json"))
        out = []
        for name in names:
            stream = self.fs.open(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}"))
            try:
                out.append(json.loads(bytes(stream.readAllBytes()).decode()))
            finally:
                stream.close()
        return out

    def append(self, number: int, record: dict) -> None:
        """Create record ``number``, whole; refused if it is there."""
        data = json.dumps(record, sort_keys=True, ensure_ascii=False).encode()
        if self.fs.getScheme() == "file":  # whose create() looks first and then creates; a hard link does both at once
            target = self._at(number).toUri().getPath()
            part = f"{target}.{uuid.uuid4().hex}"
            with open(part, "xb") as out:
                out.write(data)
            try:
                os.link(part, target)
            except FileExistsError as error:
                raise Refused("conflict", f"record {number} exists") from error
            finally:
                os.unlink(part)
            return
        try:
            stream = self.fs.create(self._at(number), False)
        except Exception as error:  # the file system's own class, told by its message
            if "exist" in str(error).lower():
                raise Refused("conflict", f"record {number} exists") from error
            raise
        try:
            stream.write(bytearray(data))
        finally:
            stream.close()


class Registry:
    """Which release is current. Every change names the version and generation it starts from."""

    def __init__(self, spark: SparkSession, root: str):
        self.events, self.audit = Log(spark, f"{root}/events"), Log(spark, f"{root}/audit")

    def history(self) -> list[dict]:
        return self.events.records()

    def current(self) -> dict | None:
        events = self.history()
        return events[-1] if events else None

    def seed(self, version: str, manifest_hash: str) -> dict:
        event = {"type": "seed", "from_version": None, "to_version": version, "generation": "gen-1", "operation_id": f"seed-{version}", "manifest_hash": manifest_hash}
        self.events.append(1, event)
        return event

    def change(self, kind: str, version: str, expected: tuple[str, str], approval: dict, operation_id: str, verify: Callable[[str], dict]) -> dict:
        """Promote (any verified release) or roll back (a release that was current before).

        ``verify`` returns valid and manifest_hash of a release, or raises KeyError if there is none. An
        operation that was done already is answered from the log.
        """
        events = self.history()
        for event in events:
            if event["operation_id"] == operation_id and event["to_version"] == version:
                return event | {"idempotent": True}
        try:
            return self._change(kind, version, expected, approval, operation_id, verify, events)
        except Refused as refusal:
            self.audit.append(len(self.audit.records()) + 1, {"type": f"{kind}_failed", "reason": refusal.kind, "detail": str(refusal), "version": version, "operation_id": operation_id})
            raise

    def _change(self, kind, version, expected, approval, operation_id, verify, events) -> dict:
        if not events:
            raise Refused("not_found", "there is no current release")
        now = events[-1]
        if (now["to_version"], now["generation"]) != tuple(expected):
            raise Refused("conflict", f"current is {now['to_version']} at {now['generation']}")
        if kind == "rollback" and version not in {e["to_version"] for e in events[:-1]}:
            raise Refused("not_found", f"{version} was never current")
        try:
            verdict = verify(version)
        except KeyError as missing:
            raise Refused("not_found", f"no manifest of {version}") from missing
        if not verdict["valid"]:
            raise Refused("verification_failed", f"{version} is not valid")
        if not all(str(approval.get(k) or "").strip() for k in ("reviewer", "reason", "policy")):
            raise Refused("approval_required", "an approval needs reviewer, reason and policy")
        if approval.get("target_manifest_hash") != verdict["manifest_hash"]:
            raise Refused("approval_required", "the approval is for another manifest")
        number = int(now["generation"].removeprefix("gen-")) + 1
        event = {
            "type": kind, "from_version": now["to_version"], "to_version": version, "generation": f"gen-{number}", "operation_id": operation_id,
            "manifest_hash": verdict["manifest_hash"], "approval": approval, "fence": hashlib.sha256(f"{operation_id}gen-{number}".encode()).hexdigest()[:16],
        }
        self.events.append(number, event)
        return event


class Idempotency:
    """ST05, K14: a key belongs to one fingerprint for good."""

    def __init__(self, spark: SparkSession, root: str):
        self.log = Log(spark, root)

    def bind(self, key: str, fingerprint: str, run_id: str) -> str:
        """The run of this key: ``run_id`` if the key is new; refused if it belongs to another fingerprint."""
        have = self.log.records()
        for record in have:
            if record["key"] == key:
                if record["fingerprint"] != fingerprint:
                    raise Refused("conflict", f"{key} belongs to another run")
                return record["run_id"]
        self.log.append(len(have) + 1, {"key": key, "fingerprint": fingerprint, "run_id": run_id})
        return run_id


class Lease:
    """ST04: one holder at a time; each acquisition has a higher generation, and work of a lower one is refused."""

    def __init__(self, spark: SparkSession, root: str, seconds: float = 60.0):
        self.log, self.seconds = Log(spark, root), seconds

    def acquire(self, holder: str, now: float) -> int:
        have = self.log.records()
        if have and have[-1]["holder"] != holder and have[-1]["expires"] > now:
            raise Refused("conflict", f"held by {have[-1]['holder']}")
        self.log.append(len(have) + 1, {"holder": holder, "expires": now + self.seconds})
        return len(have) + 1

    def check(self, generation: int, now: float) -> None:
        have = self.log.records()
        if generation != len(have) or have[-1]["expires"] <= now:
            raise Refused("conflict", "the lease was lost")


def limit_of(value: int | str | None, default: int = 100, most: int = 100) -> int:
    """A whole number from 1 to ``most``; text of one counts, truth values don't."""
    if value is None:
        return default
    text = value.strip().removeprefix("+") if isinstance(value, str) else value
    if isinstance(value, bool) or not isinstance(value, int | str) or isinstance(text, str) and not text.removeprefix("-").isdecimal() or not 1 <= int(text) <= most:
        raise Refused("invalid", f"limit must be a whole number from 1 to {most}")
    return int(text)


def selector_errors(consumer: str, track: str, release: str, consumers: tuple[str, ...], rejected: tuple[str, ...] = (), generator: str | None = None, schema: str | None = None) -> list[str]:
    """What is wrong with a selection of a projection."""
    errors = []
    for name, value, allowed in (("consumer", consumer, consumers), ("track", track, tuple(SCHEMAS))):
        if not (value or "").strip():
            errors.append(f"{name} is required")
        elif value.lower() in rejected or value not in allowed:
            errors.append(f"unsupported {name}: {value}")
    if not (release or "").strip():
        errors.append("release is required")
    if generator not in (None, GENERATOR):
        errors.append(f"unsupported generator: {generator}")
    if schema is not None and SCHEMAS.get(track, schema) != schema:
        errors.append(f"unsupported schema: {schema}")
    errors += [f"{name} is path-like" for name, value in (("consumer", consumer), ("track", track), ("release", release)) if any(x in (value or "") for x in ("/", "\\", "..", ":"))]
    return errors


def inside(root: str, relative: str) -> bool:
    """Whether a relative path stays under its root."""
    depth = 0
    for part in relative.replace("\\", "/").split("/"):
        depth += -1 if part == ".." else 0 if part in ("", ".") else 1
        if depth < 0:
            return False
    return bool(root) and not relative.startswith(("/", "\\")) and "\x00" not in relative and "://" not in relative
