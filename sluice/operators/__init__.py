"""sluice.operators."""
