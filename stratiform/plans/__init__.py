"""Whole jobs: entity runs, the gold star, the semantic model and the query catalogue."""
