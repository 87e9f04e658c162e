"""Connectors: topic (Kafka or offline), message table (Delta or Parquet), fixtures."""
