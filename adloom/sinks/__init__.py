"""Writing tables."""
