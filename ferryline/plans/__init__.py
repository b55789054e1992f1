"""Named queries with bound parameters."""
