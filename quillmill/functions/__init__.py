"""Column functions: text rules as built-in expressions, plus the small Arrow helpers."""
