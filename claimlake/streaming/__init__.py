"""Incremental (file-drop) refresh with Structured Streaming."""
