"""detlake: a Spark-native analytics engine for object-detection data."""
