"""Incremental processing and streaming state."""
