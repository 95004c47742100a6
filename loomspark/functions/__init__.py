"""Functions of the chain engine."""
