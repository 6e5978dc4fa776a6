"""Column-level building blocks: casts, dates, exact rounding, ratios, measures."""
