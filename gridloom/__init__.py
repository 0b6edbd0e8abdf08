"""Spreadsheet-style analytics over Spark DataFrames."""
