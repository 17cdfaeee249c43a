"""Column functions: lineage strings, feature ids and special functions."""
