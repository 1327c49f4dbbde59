"""Structured Streaming jobs. They call the batch operators; only sinks and state live here."""
