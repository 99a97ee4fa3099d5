"""Structured Streaming forms of the lake append and the anomaly detector."""
