"""revlens sources."""
