"""Sensor-reading analytics expressed as lazy Spark DataFrame operators."""
