"""corate.plans."""
