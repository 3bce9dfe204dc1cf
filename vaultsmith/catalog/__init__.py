"""Checked queries over the TPC-H-style test tables: Spark side and SQL oracle."""
