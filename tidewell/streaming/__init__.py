"""Streaming form of the file poll."""
