"""Column expressions: casts, cleaning, personal-data masks and business rules."""
