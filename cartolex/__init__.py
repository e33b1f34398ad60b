"""Spark-native engine for labelled map-polygon text datasets."""

__version__ = "0.1.0"
