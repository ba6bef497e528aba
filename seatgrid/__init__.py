"""Spark jobs that turn nested event-market snapshots into flat, model-ready tables."""

__version__ = "0.1.0"
