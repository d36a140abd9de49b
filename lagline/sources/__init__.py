"""Reading, naming and writing tables."""
