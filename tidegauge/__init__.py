"""Telemetry scoring, rollups and monitoring queries as Spark DataFrame functions."""
