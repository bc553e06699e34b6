"""The warehouse built from the generic test tables, and one query per operator with its SQL check."""
