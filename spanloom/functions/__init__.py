"""Column expressions: text, regular expressions, ids, vectors."""
