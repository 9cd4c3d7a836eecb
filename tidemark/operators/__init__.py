"""Operators over canonical rows: routing, gates, the store, analytics, observability."""
