"""Whole jobs put together from operators, sources and sinks."""
