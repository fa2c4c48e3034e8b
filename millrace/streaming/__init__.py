"""Structured Streaming: the batch plans, one micro-batch at a time."""
