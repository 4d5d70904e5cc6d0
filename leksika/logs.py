"""Structured logs: one JSON object a line, with context, secrets masked by key."""

from __future__ import annotations

import json
import logging
import re
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from leksika.functions import text

SECRET = re.compile(text.SECRET)
MASK = "[REDACTED]"
_context: ContextVar[dict] = ContextVar("leksika_log_context", default={})


def masked(value: object, key: str = "") -> object:
    """``value`` with whatever stands under a key that looks like a secret's masked, at any depth."""
    if SECRET.search(key):
        return MASK
    if isinstance(value, dict):
        return {k: masked(v, str(k)) for k, v in value.items()}
    if isinstance(value, list | tuple):
        return [masked(v) for v in value]
    return value


@contextmanager
def context(**fields: object) -> Iterator[None]:
    """Fields (run_id, request_id, ...) that each line within has."""
    token = _context.set(_context.get() | fields)
    try:
        yield
    finally:
        _context.reset(token)


class JsonFormatter(logging.Formatter):
    def format(self, record: logging.LogRecord) -> str:
        extra = getattr(record, "fields", {})
        line = {"level": record.levelname, "logger": record.name, "message": record.getMessage()} | _context.get() | extra
        return json.dumps(masked(line), sort_keys=True, ensure_ascii=False, default=str)


def configure(level: int = logging.INFO) -> logging.Logger:
    logger = logging.getLogger("leksika")
    handler = logging.StreamHandler()
    handler.setFormatter(JsonFormatter())
    logger.handlers, logger.propagate = [handler], False
    logger.setLevel(level)
    return logger
