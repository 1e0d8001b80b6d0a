"""Incremental pick-up of newly landed bronze folders."""
