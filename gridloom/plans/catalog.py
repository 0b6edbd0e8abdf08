"""Imports the modules that register queries."""

from gridloom.plans import deep_queries, function_queries, more_queries, pivot_queries, range_queries, value_queries  # noqa: F401
