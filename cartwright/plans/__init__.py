"""Batch flows composed from the operators."""
