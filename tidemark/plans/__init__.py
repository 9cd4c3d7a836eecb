"""Pipelines: shape, gate, route and commit in one job for all instruments."""
