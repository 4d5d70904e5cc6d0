"""All queries of the library by name, and the SQL that checks them."""

from __future__ import annotations

from leksika.plans import candidates, corpus, derived, general, ingest, lookups, published, text
from leksika.plans.registry import Query

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
for _module in (lookups, text, corpus, ingest, published, derived, general, candidates):
    QUERIES |= _module.query.queries
    SQL |= _module.query.sql
