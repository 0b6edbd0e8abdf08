"""Dynamic-array functions: over array columns where a value holds the array, over DataFrames where rows do.

A range of rows is a DataFrame with an order column ``ord``; the functions below keep or remake it.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.window import Window

from gridloom.functions.base import c, fn
from gridloom.functions.ordered import Fold, scan, sort_columns

ORD = "ord"


def numbered(df: DataFrame, by: list[str], keys: list[str] | None = None, name: str = ORD) -> DataFrame:
    """``df`` with a gapless order column from 0, by the columns ``by`` ("-name" falls).

    Without ``keys`` the order is cut into stretches, so that no task sorts all rows; tell ties apart by
    further columns of ``by``.
    """
    if keys:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*sort_columns(by))) - 1)
    return scan(df, by, {name: Fold("count", F.lit(1))}).withColumn(name, F.col(name) - 1)


# Over array columns.
fn("SEQUENCE")(lambda n, start=1, step=1: F.transform(F.sequence(F.lit(0), c(n).cast("int") - 1), lambda i: c(start) + i * c(step)))
fn("MAP")(lambda *x: F.transform(x[0], x[1]) if len(x) == 2 else F.zip_with(x[0], x[1], x[2]))
fn("BYROW")(lambda matrix, f: F.transform(matrix, f))
fn("BYCOL")(lambda matrix, f: F.transform(transpose(matrix), f))
fn("MAKEARRAY")(lambda rows, cols, f: F.transform(F.sequence(F.lit(1), c(rows)), lambda i: F.transform(F.sequence(F.lit(1), c(cols)), lambda j: f(i, j))))
fn("TEXTSPLIT")(lambda s, by, rows=None: F.split(s, "\\Q" + by + "\\E", -1) if rows is None else F.transform(F.split(s, "\\Q" + rows + "\\E", -1), lambda r: F.split(r, "\\Q" + by + "\\E", -1)))


@fn("SCAN")
def scan_array(start, array, f: Callable[[Column, Column], Column]) -> Column:
    """Every step of a fold over an array.

    Blocks of about the square root of the length are folded one after another, each appending its steps to
    an array of its own: what is copied grows with n times that root, and each element is folded once.
    """
    n = F.size(array)
    width = F.greatest(F.ceil(F.sqrt(n)).cast("int"), F.lit(1))
    numbers = F.when(n > 0, F.sequence(F.lit(0), F.floor((n - 1) / width).cast("int"))).when(n == 0, F.array().cast("array<int>"))
    blocks = F.transform(numbers, lambda i: F.slice(array, i * width + 1, width))
    steps = lambda block, at: F.aggregate(block, F.array(at), lambda held, x: F.concat(held, F.array(f(F.element_at(held, -1), x))))
    done = F.aggregate(blocks, F.array(F.array(c(start))), lambda held, block: F.concat(held, F.array(steps(block, F.element_at(F.element_at(held, -1), -1)))))
    return F.flatten(F.transform(F.slice(done, F.lit(2), F.size(done)), lambda b: F.slice(b, F.lit(2), F.size(b))))


@fn("TRANSPOSE")
def transpose(matrix: Column) -> Column:
    """Of an array of rows of equal length."""
    return F.transform(F.sequence(F.lit(0), F.size(F.get(matrix, F.lit(0))) - 1), lambda j: F.transform(matrix, lambda r: F.get(r, j)))


fn("TOCOL", "TOROW")(lambda matrix, by_column=False: F.flatten(transpose(matrix) if by_column else matrix))
fn("TAKE")(lambda a, n: F.slice(a, F.lit(1), F.least(F.lit(abs(n)), F.size(a))) if n >= 0 else F.slice(a, F.greatest(F.size(a) + n + 1, F.lit(1)), F.least(F.lit(-n), F.size(a))))
fn("DROP")(lambda a, n: F.slice(a, F.lit(n + 1), F.greatest(F.size(a) - n, F.lit(0))) if n >= 0 else F.slice(a, F.lit(1), F.greatest(F.size(a) + n, F.lit(0))))
fn("CHOOSEROWS")(lambda a, *i: F.array(*[F.try_element_at(a, F.lit(x)) for x in i]))
fn("CHOOSECOLS")(lambda m, *i: F.transform(m, lambda r: F.array(*[F.try_element_at(r, F.lit(x)) for x in i])))
fn("EXPAND")(lambda a, n, pad=None: F.when(F.size(a) <= n, F.concat(a, F.array_repeat(c(pad), F.greatest(F.lit(n) - F.size(a), F.lit(0))))))
fn("VSTACK")(lambda *m: F.concat(*m))
fn("HSTACK")(lambda a, b: F.arrays_zip(a, b))
fn("WRAPROWS")(lambda a, n, pad=None: F.transform(F.sequence(F.lit(0), F.ceil(F.size(a) / n).cast("int") - 1), lambda i: F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda j: F.when(i * n + j < F.size(a), F.get(a, i * n + j)).otherwise(c(pad)))))
fn("WRAPCOLS")(lambda a, n, pad=None: transpose(F.transform(F.sequence(F.lit(0), F.ceil(F.size(a) / n).cast("int") - 1), lambda i: F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda j: F.when(i * n + j < F.size(a), F.get(a, i * n + j)).otherwise(c(pad))))))
fn("SORT")(lambda a, descending=False: F.sort_array(a, asc=not descending))
fn("SORTBY")(lambda a, by, descending=False: F.transform(F.sort_array(F.zip_with(by, a, lambda k, v: F.struct(k.alias("k"), v.alias("v"))), asc=not descending), lambda e: e["v"]))
fn("UNIQUE")(lambda a, once=False: F.filter(a, lambda x: F.size(F.filter(a, lambda y: y == x)) == 1) if once else F.array_distinct(a))
fn("FILTER")(lambda a, include, if_empty=None: _or_else(F.transform(F.filter(F.arrays_zip(a.alias("a"), include.alias("k")), lambda e: e["k"]), lambda e: e["a"]), if_empty) if isinstance(include, Column) else _or_else(F.filter(a, include), if_empty))
fn("LET")(lambda value, body: F.get(F.transform(F.array(c(value)), body), F.lit(0)))
fn("LAMBDA")(lambda f: f)


def _or_else(found: Column, if_empty) -> Column:
    return found if if_empty is None else F.when(F.size(found) > 0, found).otherwise(F.array(c(if_empty)))


# Over rows.
def unique_rows(df: DataFrame, columns: list[str], once: bool = False) -> DataFrame:
    if once:
        return df.groupBy(*columns).agg(F.count("*").alias("__n")).where("__n = 1").select(*columns)
    return df.select(*columns).distinct()


def running(df: DataFrame, value: str, order: str, keys: list[str] | None = None, how: str = "sum", name: str = "running", spread: bool = False) -> DataFrame:
    """SCAN with a sum, count, min or max: the aggregate of each row and those before it in its keys.

    Without keys, or with ``spread`` where some keys fill many tasks, the order is cut into stretches.
    """
    if spread or not keys:
        return scan(df, [order], {name: Fold(how, F.col(value))}, keys or [])
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, Fold(how, F.col(value)).over(w))


def sum_before(df: DataFrame, by: str, amount: str, ties: list[str] | None = None, descending: bool = False, name: str = "before") -> DataFrame:
    """``df`` with the sum of ``amount`` over all rows that come before in the order of ``by``, then ``ties``.

    Approximate quantiles cut the numbers ``by`` into as many stretches as there are shuffle partitions; a
    stretch is summed in a task of its own and takes over the totals of those before it, of which the driver
    holds one for each. Rows of one value of ``by`` share a task: aggregate such rows first.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = sorted(set(df.approxQuantile(by, [i / n for i in range(1, n)], 0.01)))
    stretch = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda x: x < F.col(by))) if cuts else F.lit(0)
    placed = df.withColumn("__s", F.when(F.col(by).isNull(), -1).otherwise(-stretch if descending else stretch))
    totals = {r["__s"]: r["t"] or 0 for r in placed.groupBy("__s").agg(F.sum(amount).alias("t")).collect()}
    start, total = [], 0
    for s in sorted(totals):
        start += [F.lit(s), F.lit(total)]
        total += totals[s]
    order = F.col(by).desc() if descending else F.col(by).asc()
    inside = F.sum(amount).over(Window.partitionBy("__s").orderBy(order, *(ties or [])).rowsBetween(Window.unboundedPreceding, -1))
    held = F.try_element_at(F.create_map(*start), F.col("__s")) if start else F.lit(0)
    return placed.withColumn(name, F.coalesce(inside, F.lit(0)) + held).drop("__s")


def rows_between(df: DataFrame, first: int | None = None, last: int | None = None, order: str = ORD) -> DataFrame:
    """TAKE and DROP on numbered rows."""
    keep = F.lit(True)
    if first is not None:
        keep = keep & (F.col(order) >= first)
    if last is not None:
        keep = keep & (F.col(order) < last)
    return df.where(keep)


def stack_rows(*frames: DataFrame) -> DataFrame:
    """VSTACK: rows one under another, missing columns NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def stack_columns(left: DataFrame, right: DataFrame, order: str = ORD) -> DataFrame:
    """HSTACK: numbered rows side by side; the shorter side's missing rows are NULL."""
    return left.join(right, order, "full")


def unpivot(df: DataFrame, ids: list[str], values: list[str], name: str = "column", value: str = "value") -> DataFrame:
    """TOCOL of a wide range, with the column each value came from."""
    return df.unpivot(ids, values, name, value)


def matrix_product(a: DataFrame, b: DataFrame) -> DataFrame:
    """MMULT of matrices in (i, j, v) rows: a join on the inner index and a sum."""
    right = b.select(F.col("i").alias("k"), F.col("j").alias("j2"), F.col("v").alias("v2"))
    joined = a.select("i", F.col("j").alias("k"), "v").join(right, "k")
    return joined.groupBy("i", F.col("j2").alias("j")).agg(F.sum(F.col("v") * F.col("v2")).alias("v"))


def _matrix(kind: str, f) -> Callable[[Column], Column]:
    import numpy as np

    def batch(m: pd.Series) -> pd.Series:
        out = []
        for rows in m:
            a = np.array([list(r) for r in rows], float) if rows is not None and len(rows) else np.zeros((0, 1))
            try:
                out.append(f(a) if a.shape[0] == a.shape[1] else None)
            except np.linalg.LinAlgError:
                out.append(None)
        return pd.Series(out)

    return pandas_udf(batch, kind)


def _inverse(a):
    import numpy as np

    return np.linalg.inv(a).tolist()


def _determinant(a):
    import numpy as np

    return float(np.linalg.det(a))


fn("MDETERM")(lambda m: _matrix("double", _determinant)(m))
fn("MINVERSE")(lambda m: _matrix("array<array<double>>", _inverse)(m))
fn("MMULT")(lambda a, b: F.transform(a, lambda r: F.transform(transpose(b), lambda col: F.aggregate(F.zip_with(r, col, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v))))
fn("INDEX")(lambda a, row, col=None: F.try_element_at(a, c(row)) if col is None else F.try_element_at(F.try_element_at(a, c(row)), c(col)))
fn("ROWS")(lambda a: F.size(a))
fn("COLUMNS")(lambda a: F.size(F.get(a, F.lit(0))))
fn("ROW")(lambda order=ORD: F.col(order) + 1)
fn("AREAS")(lambda *ranges: F.lit(max(1, len(ranges))))
fn("COLUMN")(lambda df, name: F.lit(df.columns.index(name) + 1))
fn("SHEETS")(lambda names: F.lit(len(names)))
fn("SHEET")(lambda names, name: F.lit([n.lower() for n in names].index(name.lower()) + 1))
fn("CELL")(lambda info, cell: {"address": F.concat(F.lit("$"), cell["col"], F.lit("$"), cell["row"]), "row": cell["row"], "col": cell["col"], "contents": cell["text"], "type": F.when(cell["text"].isNull(), "b").when(cell["kind"] == "string", "l").otherwise("v")}[info.lower()])


def indirect(spark: SparkSession, name: str) -> DataFrame:
    """INDIRECT: a named range, table or sheet is a view."""
    return spark.table(name)


@fn("ADDRESS")
def address(row, col, kind: int = 1, a1: bool = True, sheet: str | None = None) -> Column:
    """A1 or R1C1 text; kind 1 all absolute, 2 row, 3 column, 4 none."""
    row, col = c(row).cast("int"), c(col).cast("int")
    if not a1:
        text = F.concat(F.lit("R"), *([row.cast("string")] if kind in (1, 2) else [F.lit("["), row.cast("string"), F.lit("]")]), F.lit("C"), *([col.cast("string")] if kind in (1, 3) else [F.lit("["), col.cast("string"), F.lit("]")]))
    else:
        letter = lambda n: F.char(n + 65)
        two, three = col - 27, col - 703
        letters = F.when(col <= 26, letter(col - 1)).when(col <= 702, F.concat(letter(F.floor(two / 26)), letter(two % 26))).otherwise(F.concat(letter(F.floor(three / 676)), letter(F.floor(three / 26) % 26), letter(three % 26)))
        text = F.concat(F.lit("$" if kind in (1, 3) else ""), letters, F.lit("$" if kind in (1, 2) else ""), row.cast("string"))
    return text if sheet is None else F.concat(F.lit(f"{sheet}!" if sheet.isidentifier() else f"'{sheet}'!"), text)
