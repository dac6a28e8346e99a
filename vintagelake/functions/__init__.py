"""Column-level building blocks: calendar arithmetic and first-match rule tables."""
