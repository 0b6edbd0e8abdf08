"""Operators over DataFrames: pivots, lookups, selectors, range operations, profiling and documents."""
