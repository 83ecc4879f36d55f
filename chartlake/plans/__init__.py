"""Plans: transforms, read queries, the one-run job, and the registered queries."""
