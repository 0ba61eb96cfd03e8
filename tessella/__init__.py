"""Spark-native analytics over tables of cells, and over the tables around them."""

__version__ = "0.1.0"
