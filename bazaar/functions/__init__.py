"""Column expressions: cleaning, calendar attributes and exact measures."""
