"""Incremental raw-file ingestion with Structured Streaming.

The source system loads raw files in one-shot batches; here the same load
(typed read, missing-value tokens, lineage, key-checked append) can run
incrementally: new files in a landing folder are picked up once each, with
progress kept in a checkpoint on shared storage.
"""

from tallyrisk.streaming.ingest import start_ingest, start_ingest_all

__all__ = ["start_ingest", "start_ingest_all"]
