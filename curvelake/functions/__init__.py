"""Column expressions: they stay inside generated code and also work on streams."""
