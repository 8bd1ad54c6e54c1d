"""geoweave.sources."""
