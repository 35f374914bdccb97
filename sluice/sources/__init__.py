"""sluice.sources."""
