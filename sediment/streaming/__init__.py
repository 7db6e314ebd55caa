"""Incremental form of the daily run: landing folders as a file stream."""
