"""DataFrame operators: flattening, upsert, numbering, keep-latest, layout, lookups."""
