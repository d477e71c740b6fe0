"""Value types and SQL table functions."""
