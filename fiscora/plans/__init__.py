"""Composed jobs: Silver models, the Gold mart, ingest, and reports."""
