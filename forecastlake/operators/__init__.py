"""Operators: parsing, flattening, validation, quality queries and state."""
