"""Plans of the chain engine."""
