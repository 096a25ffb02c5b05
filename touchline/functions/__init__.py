"""Column functions: text keys, value parsing, name similarity."""
