"""Column expressions: keys, dates, text, units and geometry."""
