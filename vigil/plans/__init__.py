"""vigil.plans."""
