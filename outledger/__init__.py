"""Outbound master-data analytics on Spark: extract, resolve, nest, deliver, track."""

__version__ = "0.1.0"
