"""Readers: store databases, lake snapshots, files and event topics."""
