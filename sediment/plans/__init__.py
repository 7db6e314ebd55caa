"""Composite jobs: landing to silver, silver to gold, prices, ordered backfill."""
