"""textmill.functions."""
