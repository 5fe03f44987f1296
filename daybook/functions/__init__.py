"""Column functions: dates and text."""
