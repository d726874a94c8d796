"""Column functions and the ordered-count building blocks."""
