"""Batch, streaming and model analytics over timestamped meter readings, on Spark."""
