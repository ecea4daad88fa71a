"""Column functions: cleaning, text, time and geometry."""
