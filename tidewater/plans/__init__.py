"""Query registry: each named query has a Spark plan and an oracle SQL text."""
