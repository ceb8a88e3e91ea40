"""Scalar column expressions."""
