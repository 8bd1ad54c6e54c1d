"""geoweave.sinks."""
