"""Incremental loads of newly arrived files."""
