"""corate.functions."""
