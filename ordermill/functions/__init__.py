"""Column expressions: casts, calendar, money and text."""
