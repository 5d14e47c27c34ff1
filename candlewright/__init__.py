"""Spark pipelines for market candles and channel messages."""

__version__ = "0.1.0"
