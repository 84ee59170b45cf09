"""Incremental ingestion of event files."""
