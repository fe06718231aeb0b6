"""Every catalogue query with the SQL that gives the same rows."""

from __future__ import annotations

from colloquy.plans import enrichment, events, flows, reporting, storage

QUERIES = {**reporting.R.queries, **storage.R.queries, **enrichment.R.queries, **flows.R.queries, **events.R.queries}
ORACLE_SQL: dict[str, str] = {**reporting.R.sql, **storage.R.sql, **enrichment.R.sql, **flows.R.sql, **events.R.sql}
