"""millrace: incremental extract-load as Spark jobs."""
