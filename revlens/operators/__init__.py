"""revlens operators."""
