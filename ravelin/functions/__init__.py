"""Column expressions: text splitting, vector arithmetic, embedders."""
