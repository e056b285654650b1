"""Spark-native preparation of image/question/answer training data."""

__version__ = "0.1.0"
