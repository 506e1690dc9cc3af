"""Operators on DataFrames: predicates, projections, merge-on-read, display and batches."""
