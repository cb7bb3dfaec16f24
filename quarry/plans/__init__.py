"""Plan-level helpers (size-checked broadcast, ordered scans, ids) and the query registry."""
