"""Readers of landed files and sinks for results."""
