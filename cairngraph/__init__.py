"""Memory-graph and code-graph analytics as Spark DataFrame jobs."""
