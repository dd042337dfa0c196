"""The operators bound to the given tables, and the same results as plain SQL."""
