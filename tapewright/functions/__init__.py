"""Scalar expressions: Column in, Column out."""
