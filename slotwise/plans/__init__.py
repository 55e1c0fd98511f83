"""Query registry and multi-table jobs."""
