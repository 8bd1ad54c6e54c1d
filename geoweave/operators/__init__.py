"""geoweave.operators."""
