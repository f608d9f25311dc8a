"""textmill.operators."""
