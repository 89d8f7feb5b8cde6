"""Degrees of a growing graph."""
