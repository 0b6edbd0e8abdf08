"""Spreadsheet functions as Spark Columns; ``call(name, ...)`` finds one by its formula name."""

from gridloom.functions import arrays, dates, distributions, engineering, finance, logic, math, stats, text  # noqa: F401
from gridloom.functions.base import CATALOGUE, call  # noqa: F401
from gridloom.operators import criteria, lookup  # noqa: F401  (both enter functions)
