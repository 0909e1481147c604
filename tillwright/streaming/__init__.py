"""Structured Streaming jobs over loyalty events and orders."""
