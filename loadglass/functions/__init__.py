"""Column expressions: rounding, ratios, calendar, labels and the load model."""
