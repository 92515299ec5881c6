"""Operators for training-data pipelines over a `documents` frame.

Every operator takes DataFrames and returns DataFrames; Spark partitions and
shuffles the work, and numpy runs inside tasks where a built-in function cannot
say what is needed.
"""
