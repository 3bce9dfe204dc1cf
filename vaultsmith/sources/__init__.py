"""Scans: source tables, virtual SQL sources, vault targets, metadata."""
