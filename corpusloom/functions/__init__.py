"""Column functions: text, JSON, draws, arrays and numbers."""
