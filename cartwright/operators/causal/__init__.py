"""Causal estimates from observational data."""
