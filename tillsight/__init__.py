"""Retail customer analytics as Spark jobs: features, quality, scoring, drift and outcome tracking."""

__version__ = "0.1.0"
