"""Request logs and streams: ``replay`` (mode, last query, page position —
batch scans and stateful streams), ``debounce`` (session windows, batch and
stream) and ``ingest`` (checkpointed page ingestion)."""
