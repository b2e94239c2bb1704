"""The incremental forms of ingest, resampling, deduplication, sessions and gap detection."""
