"""Sources of the chain engine."""
