"""Structured Streaming daily load."""
