"""Table builders: dimensions, fact, marts, reports, quality checks, warehouse refresh."""
