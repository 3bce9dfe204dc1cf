"""Column builders: keys, hashes, meta columns, window helpers."""
