"""Column functions: collections, text, dates and code systems."""
