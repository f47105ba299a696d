"""revlens streaming."""
