"""Column -> Column building blocks; all of them are built-in, code-generated expressions."""
