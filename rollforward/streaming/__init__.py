"""Structured Streaming form of the replay."""
