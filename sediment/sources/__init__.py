"""Readers: landing files, payload text, catalog tables, the driver's test tables."""
