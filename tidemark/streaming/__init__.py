"""The pipelines' streaming forms."""
