"""Scalar and table functions for SQL."""
