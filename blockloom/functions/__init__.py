"""Column expressions: hex and bytes, 256-bit integers, periods, text."""
