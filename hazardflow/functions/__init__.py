"""Column expressions: casts, flood features, fire features, alert levels."""
