"""Readers, writers and the edge between Spark and the client."""
