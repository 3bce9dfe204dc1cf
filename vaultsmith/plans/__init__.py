"""Whole-vault runs (dependency order) and plan inspection helpers."""
