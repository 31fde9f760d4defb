"""Spark-native analytics for short-dated binary contracts and the futures they settle on."""

__version__ = "0.1.0"
