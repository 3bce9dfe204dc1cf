"""Operators for preparing training data: formatting, packing, fixity, token files,
URL rules, exact top-k, subword lattices, toxicity, quality rules and near-duplicates.

Nothing else in the library imports this subpackage.
"""
