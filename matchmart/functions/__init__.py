"""Column expressions: keys, paths, ratios and scorecard rules. No Python UDFs."""
