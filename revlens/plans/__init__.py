"""revlens plans."""
