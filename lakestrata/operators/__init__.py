"""Table operators: dedupe, upsert, surrogate keys, lineage, lookups, ranking, duplicate counts, writes."""
