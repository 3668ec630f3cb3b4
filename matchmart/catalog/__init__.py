"""The named queries: test-table fixtures, Spark builders and their SQL counterparts."""
