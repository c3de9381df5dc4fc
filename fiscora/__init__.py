"""Company-fundamentals analytics as Spark DataFrame jobs.

Layers: raw JSON payloads (Bronze) -> typed fiscal periods (Silver) -> one wide
KPI table (Gold), with the ingest contract, incremental ingest, quality gates
and audit roll-ups around them.
"""
