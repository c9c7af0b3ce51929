"""Layered analytics tables for session-based timing and telemetry data, on PySpark."""

__version__ = "0.1.0"
