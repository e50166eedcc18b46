"""What to run: the source registry, the ingestion of each source, and queries."""
