"""Layer plans: Bronze ingestion, Silver cleaning, Gold star schema, analytics."""
