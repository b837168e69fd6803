"""Reading raw files and writing or listing tables."""
