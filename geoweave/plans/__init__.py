"""geoweave.plans."""
