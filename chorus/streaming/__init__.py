"""Incremental versions of ingest, duplicate removal and result upsert."""
