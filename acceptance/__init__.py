"""Market feeds derived from the test tables, the queries on them, and their oracles."""
