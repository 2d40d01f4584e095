"""Sensor telemetry on Spark: line ingest, publishing, range queries, replication."""
