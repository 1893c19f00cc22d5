"""Incremental processing as a stream of files."""
