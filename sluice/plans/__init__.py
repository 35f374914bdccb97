"""sluice.plans."""
