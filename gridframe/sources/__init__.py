"""Stores, discovery, decoding, and the Spark data source."""
