"""Column expressions: typed parsing, canonical text, dates, and the feature catalog."""
