"""Lineage, derived graphs and the registered queries."""
