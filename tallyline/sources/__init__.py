"""Readers and parsers of bank result files and tables."""
