"""Relational operators of the reconciliation."""
