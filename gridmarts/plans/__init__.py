"""Staging models, dimensions, facts, tiers and the queries on them."""
