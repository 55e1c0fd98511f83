"""Table and file sources."""
