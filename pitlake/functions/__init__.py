"""Scalar expressions and fixed values; every function takes and returns Columns."""
