"""Customer lifecycle analytics on Spark: ingest, score, and report on append-only logs."""
