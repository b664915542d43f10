"""Sensor-network time series on Spark: DataFrame -> DataFrame transforms."""
