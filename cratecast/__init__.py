"""cratecast: Spark-native client-level demand planning."""
