"""Stored stages, report tables, and the queries over the test tables."""
