"""Stagers, loaders and the effectivity operator (pure DataFrame -> DataFrame)."""
