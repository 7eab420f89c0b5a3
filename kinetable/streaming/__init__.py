"""Structured Streaming jobs over control-plane events."""
