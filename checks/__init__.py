"""Registered queries over the test tables and the equivalent SQL."""
