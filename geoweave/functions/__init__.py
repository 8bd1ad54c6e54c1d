"""Column functions (native Spark expressions, no UDF): see ``geoweave.functions.geohash``."""
