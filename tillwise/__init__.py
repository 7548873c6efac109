"""Payments analytics on Spark: reports, features, models and scoring as DataFrame plans."""

__version__ = "0.1.0"
