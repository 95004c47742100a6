"""Streaming of the chain engine."""
