"""Spark-native analytics for feature tables and voxel tables."""

__version__ = "0.1.0"
