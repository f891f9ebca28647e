"""Whole jobs: validation, work lists, routing."""
