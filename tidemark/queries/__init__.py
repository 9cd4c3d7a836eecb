"""Registered queries: one function and, where SQL can say it, one DuckDB statement per operator."""

from __future__ import annotations

from tidemark.queries import analytics, files, holdings, ingestion, streams

_ALL = {**analytics.ENTRIES, **holdings.ENTRIES, **ingestion.ENTRIES, **streams.ENTRIES, **files.ENTRIES}

QUERIES = {name: entry[0] for name, entry in _ALL.items()}
SQL: dict[str, str] = {name: entry[1] for name, entry in _ALL.items() if entry[1]}
