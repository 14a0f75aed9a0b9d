"""Electricity-market feeds, facts, tiers and queries as Spark DataFrame jobs."""
