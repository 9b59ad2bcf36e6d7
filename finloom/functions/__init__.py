"""Column -> Column expression builders; nothing here calls Python per row."""
