"""sources."""
