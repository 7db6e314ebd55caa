"""Layered (bronze, silver, gold) batch analytics as plain PySpark DataFrame functions."""
