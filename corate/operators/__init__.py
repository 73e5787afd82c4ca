"""corate.operators."""
