"""vigil.operators."""
