"""Relational queries over chunked N-dimensional arrays, on Spark."""
