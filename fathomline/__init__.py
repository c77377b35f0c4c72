"""A PySpark-native analytics engine for append-only archives of positioned, timestamped observations."""
