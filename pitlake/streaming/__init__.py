"""Structured Streaming: ticks as they arrive, written by the same rules as batches."""
