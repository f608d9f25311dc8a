"""textmill.sources."""
