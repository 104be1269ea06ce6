"""Attestra: evidence linkage, time-aware features and case review on Spark."""

__version__ = "0.1.0"
