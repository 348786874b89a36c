"""Reading raw splits, writing and reading prepared tables."""
