"""Continuous ingest of landed files."""
