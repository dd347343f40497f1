"""Column expressions: label bands, safe ratios, trip features, p-values."""
