"""sluice.streaming."""
