"""Reproducible synthetic tables computed from row numbers."""
