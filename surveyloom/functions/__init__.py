"""Column expressions: missing-value semantics, classes, text, geometry, statistics."""
