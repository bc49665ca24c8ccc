"""Readers: recursive line scans, staging CSV with header checks, \\x01 rows,
per-file row positions and skipping, feature JSON."""
