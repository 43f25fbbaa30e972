"""Column expressions and the shared statistics helpers."""
