"""Landed feeds in, partitioned datasets out."""
