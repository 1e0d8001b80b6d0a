"""Readers for bronze data, and the landing writer that produces it."""
