"""Column builders: dates, scalars and business rules."""
