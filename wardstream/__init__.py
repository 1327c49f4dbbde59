"""Encounter-stream analytics: Spark operators from raw events to a star schema and its KPIs."""
