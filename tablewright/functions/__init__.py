"""Scalar functions, aggregates and routines."""
