"""DataFrame -> DataFrame operators (keys, windows, aggregates, panels, overdraft, enrichment)."""
