"""sluice.functions."""
