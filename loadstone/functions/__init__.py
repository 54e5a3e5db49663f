"""Column functions (no actions, no Python in the data path)."""
