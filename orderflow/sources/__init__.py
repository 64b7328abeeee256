"""Reading raw files and writing layer tables."""
