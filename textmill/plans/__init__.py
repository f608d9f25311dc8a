"""textmill.plans."""
