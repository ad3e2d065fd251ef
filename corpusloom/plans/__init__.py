"""Ready-made jobs, and the catalogue of queries with their SQL equivalents."""
