"""Structured Streaming jobs: bridge, index and replay."""
