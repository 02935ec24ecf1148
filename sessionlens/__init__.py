"""Telecom session-quality and identity-swap analytics as Spark DataFrame operators."""

__version__ = "0.1.0"
