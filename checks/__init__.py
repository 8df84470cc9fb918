"""Oracle checks (not part of the library)."""
