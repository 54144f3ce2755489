"""Incremental intake of landing files with Structured Streaming."""
