"""Scorecard analytics on Spark: nested match documents to star schema, marts and reports."""
