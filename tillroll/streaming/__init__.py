"""Incremental form of the object-store ingestion job."""
