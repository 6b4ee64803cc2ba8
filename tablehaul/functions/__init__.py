"""Column expressions: delimited text, tokens, column lists."""
