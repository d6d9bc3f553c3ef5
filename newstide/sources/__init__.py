"""Readers: landed feeds, stored tables, streams and the benchmark fixtures."""
