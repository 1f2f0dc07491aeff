"""Streaming forms: stateful operators, sinks and the five jobs."""
