"""Row transforms, aggregates, run grouping, top-k, upsert."""
