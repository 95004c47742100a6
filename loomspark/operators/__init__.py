"""Operators of the chain engine."""
