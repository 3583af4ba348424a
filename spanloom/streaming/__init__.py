"""Structured Streaming forms of the decision-log operators."""
