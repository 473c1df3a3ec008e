"""Ingestion, snapshots, enrichment and matching as Structured Streaming queries.

Sinks that merge into keyed tables run in ``foreachBatch`` and are idempotent: replaying a batch
after a failure leaves the table as it was.
"""
