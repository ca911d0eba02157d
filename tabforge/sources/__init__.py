"""Reading, caching and writing tables."""
