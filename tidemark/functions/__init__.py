"""Column expressions: no DataFrames, no paths."""
