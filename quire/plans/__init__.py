"""End-to-end plans: derivations of the given tables, the sync, the query registry."""
