"""Column expressions: tokenisers, markup stripping, label rules."""
