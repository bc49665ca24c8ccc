"""Writers and table maintenance: partitioned writes with dynamic overwrite,
feature JSON, \\x01 text, staging CSV, hand-off export, whole-table publish by
swap (with recovery), external tables in the session catalog."""
