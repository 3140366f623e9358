"""Structured Streaming form of the idempotent load (W8) for files that keep arriving."""
