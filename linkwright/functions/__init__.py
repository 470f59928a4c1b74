"""Column functions: text, extraction, similarity."""
