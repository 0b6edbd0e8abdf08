"""Logical and information functions. ``of`` names a column's static type where a cell's kind would decide."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridloom.functions.base import c, fn, num

#: Error values and the numbers ERROR.TYPE gives them, fixed values.
ERRORS = {"#NULL!": 1, "#DIV/0!": 2, "#VALUE!": 3, "#REF!": 4, "#NAME?": 5, "#NUM!": 6, "#N/A": 7, "#GETTING_DATA": 8, "#SPILL!": 9, "#CALC!": 14}

_truth = lambda x: F.coalesce(c(x).cast("boolean"), F.lit(False))  # noqa: E731  blank is false

fn("IF")(lambda test, yes, no=False: F.when(_truth(test), c(yes)).otherwise(c(no)))
fn("AND")(lambda *x: reduce(lambda a, b: a & b, map(_truth, x)))
fn("OR")(lambda *x: reduce(lambda a, b: a | b, map(_truth, x)))
fn("XOR")(lambda *x: sum((_truth(v).cast("int") for v in x), F.lit(0)) % 2 == 1)
fn("NOT")(lambda x: ~_truth(x))
fn("TRUE")(lambda: F.lit(True))
fn("FALSE")(lambda: F.lit(False))
fn("IFERROR")(lambda x, fallback: F.coalesce(c(x), c(fallback)))
fn("CHOOSE")(lambda i, *x: F.try_element_at(F.array(*map(c, x)), F.when(c(i) >= 1, c(i).cast("int"))))
fn("ISOMITTED")(lambda x=None: F.lit(x is None))
and_of = lambda x: F.bool_and(_truth(x))  # noqa: E731  over a group
or_of = lambda x: F.bool_or(_truth(x))
xor_of = lambda x: F.count_if(_truth(x)) % 2 == 1


@fn("IFNA")
def if_na(x, fallback, error=None) -> Column:
    """With an ``error`` column only #N/A is replaced, without one any NULL."""
    return F.coalesce(c(x), c(fallback)) if error is None else F.when(c(error) == "#N/A", c(fallback)).otherwise(c(x))


@fn("IFS")
def ifs(*pairs) -> Column:
    out = None
    for test, value in zip(pairs[::2], pairs[1::2]):
        out = (F if out is None else out).when(_truth(test), c(value))
    return out


@fn("SWITCH")
def switch(x, *cases) -> Column:
    out = None
    for case, value in zip(cases[::2], cases[1::2]):
        out = (F if out is None else out).when(same(c(x), c(case)), c(value))
    return out.otherwise(c(cases[-1])) if len(cases) % 2 else out


def same(a: Column, b: Column) -> Column:
    """Spreadsheet equality of text: case aside."""
    return F.lower(a.cast("string")) == F.lower(b.cast("string"))


fn("REDUCE")(lambda start, array, f: F.aggregate(array, c(start), f))
fn("ISNUMBER")(lambda x, of="double": c(x).isNotNull() & F.lit(of not in ("string", "boolean")))
fn("ISTEXT")(lambda x, of="string": c(x).isNotNull() & F.lit(of == "string"))
fn("ISNONTEXT")(lambda x, of="string": c(x).isNull() | F.lit(of != "string"))
fn("ISLOGICAL")(lambda x, of="boolean": c(x).isNotNull() & F.lit(of == "boolean"))
fn("ISBLANK")(lambda x: c(x).isNull())
fn("ISERROR")(lambda error: c(error).isNotNull())
fn("ISERR")(lambda error: c(error).isNotNull() & (c(error) != "#N/A"))
fn("ISNA")(lambda error: F.coalesce(c(error) == "#N/A", F.lit(False)))
fn("ISEVEN")(lambda x: F.floor(F.abs(num(x))) % 2 == 0)
fn("ISODD")(lambda x: F.floor(F.abs(num(x))) % 2 == 1)
fn("ISREF")(lambda x: F.lit(isinstance(x, Column)))
fn("ISFORMULA")(lambda formula: c(formula).isNotNull())
fn("TYPE")(lambda x, of="double", error=None: F.when(c(error).isNotNull() if error is not None else F.lit(False), 16).otherwise({"string": 2, "boolean": 4, "array": 64}.get(of, 1)))
fn("NA")(lambda: F.lit("#N/A"))
fn("ERROR.TYPE")(lambda error: F.try_element_at(F.create_map(*[F.lit(v) for kv in ERRORS.items() for v in kv]), c(error)))
