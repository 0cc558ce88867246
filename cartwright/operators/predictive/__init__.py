"""Churn, survival, lifetime value, clustering and recommendations."""
