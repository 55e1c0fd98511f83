"""Table and file sinks."""
