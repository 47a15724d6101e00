"""The operators run on the given tables, with the same results in SQL."""
