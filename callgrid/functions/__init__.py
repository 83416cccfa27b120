"""Column expressions: text codes, calendar, numbers, geometry and model JSON."""
