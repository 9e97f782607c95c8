"""Structured Streaming form of the loads."""
