"""corate.sources."""
