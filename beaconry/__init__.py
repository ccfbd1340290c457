"""Beaconry: application telemetry as Spark DataFrame and Structured Streaming operators."""

from beaconry.settings import Settings

__all__ = ["Settings"]
__version__ = "0.1.0"
