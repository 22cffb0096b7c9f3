"""Structured Streaming over run events."""
