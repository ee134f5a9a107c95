"""Readers: tick-stream messages, topic records, stored events."""
