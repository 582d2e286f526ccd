"""Column functions: exact rounding, stable hashing, country lookups, and the fixed values."""
