"""Structured Streaming jobs; the aggregations are shared with the batch operators."""
