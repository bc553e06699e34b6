"""Readers: files with lineage, reference CSV, array documents, generated rows, landed partitions."""
