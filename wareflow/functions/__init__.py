"""Driver-side spec helpers (column markers, expression rewrite, table
addresses) and scalar column functions built from Spark expressions."""
