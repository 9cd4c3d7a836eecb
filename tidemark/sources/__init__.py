"""Landed payload files to canonical rows."""
