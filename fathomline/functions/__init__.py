"""Column expressions: text, words, dates, ids, vectors."""
