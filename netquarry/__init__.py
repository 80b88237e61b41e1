"""Spark-native analytics for network-flow security telemetry."""
