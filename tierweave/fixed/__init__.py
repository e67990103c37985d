"""Word lists, lookup tables, patterns and constants, kept as plain data."""
