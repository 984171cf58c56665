"""Column expressions: parsing, signs, keys and rule ladders."""
