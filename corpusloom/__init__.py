"""Corpusloom: Spark-native preparation of image and text training data."""

__version__ = "0.1.0"
