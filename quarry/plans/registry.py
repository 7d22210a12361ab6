"""All registered queries and their SQL twins (``__spark_entry__`` reads these)."""

from __future__ import annotations

from . import dialogue, ingest, live, retrieval, scoring, structured

MODULES = [ingest, retrieval, structured, dialogue, scoring, live]


def queries() -> dict:
    out = {}
    for m in MODULES:
        out.update(m.QUERIES)
    return out


def oracle_sql() -> dict:
    out = {}
    for m in MODULES:
        out.update(m.SQL)
    return out
