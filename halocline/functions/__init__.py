"""Column expressions: calendar, names, numbers, positions, sea water."""
