"""vigil.sources."""
