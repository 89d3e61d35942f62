"""Column functions: normalisers, text similarity, fixed tables."""
