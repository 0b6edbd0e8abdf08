"""Issues of workbooks, found over the graph of references: formulas to cells, sheets and defined names.

References are cut out of formula texts by patterns, a row each, so that missing sheets are anti joins,
stale sums are differences of running totals at a range's ends, and circles are what is left when cells
that lead nowhere are taken away again and again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.ordered import Fold, scan
from gridloom.operators.lookup import as_of
from gridloom.staging import staged

_SHEET = r"(?:'(?:[^']|'')+'|[\p{L}_][\p{L}\d_.]*)!"
_CELL = r"\$?[A-Za-z]{1,3}\$?\d{1,7}"
REFERENCE = rf"(?:{_SHEET})?(?<![\p{{L}}\d_.$]){_CELL}(?::{_CELL})?(?![\p{{L}}\d_.(!])"
NAME = r"(?<![\p{L}\d_.!'$#])[\p{L}_\\][\p{L}\d_.]*(?![\p{L}\d_.(!'])"
SHEET_USE = rf"{_SHEET}"

#: Severity of each subtype; all are issues of content. Fixed values.
SEVERITY = {
    "formula_eval_error": "error", "formula_ref_missing_sheet": "error", "formula_not_evaluated": "warning", "formula_cache_stale": "warning",
    "definedname_broken": "error", "definedname_target_missing": "error", "formula_circular": "error",
}


def _bare(formula: Column) -> Column:
    """A formula without its texts."""
    return F.regexp_replace(formula, r'"[^"]*"', '""')


def sheet_name(use: Column) -> Column:
    """The sheet named by ``Sheet!`` or ``'my sheet'!``."""
    name = F.regexp_extract(use, r"(?s)^(.*)!", 1)
    quoted = F.replace(F.regexp_extract(name, r"(?s)^'(.*)'$", 1), F.lit("''"), F.lit("'"))
    return F.when(name.startswith("'"), quoted).otherwise(name)


def _column(letters: Column) -> Column:
    chars = F.split(F.upper(letters), "")
    return F.aggregate(F.filter(chars, lambda x: x != ""), F.lit(0), lambda n, x: n * 26 + F.ascii(x) - 64)


def references(cells: DataFrame) -> DataFrame:
    """(file, sheet, row, col, to_sheet, r1, c1, r2, c2): a row for each cell or range that a formula names, ends in order."""
    found = F.explode(F.regexp_extract_all(_bare(F.col("formula")), F.lit(f"({REFERENCE})"), F.lit(1)))
    token = cells.where(F.col("formula").isNotNull()).select("file", "sheet", "row", "col", found.alias("t"))
    at = F.regexp_extract("t", r"([^!]*)$", 1)
    part = lambda i: F.regexp_extract(at, r"^\$?([A-Za-z]{1,3})\$?(\d+)(?::\$?([A-Za-z]{1,3})\$?(\d+))?$", i)
    split = token.select(
        "file", "sheet", "row", "col", F.when(F.contains("t", F.lit("!")), sheet_name(F.col("t"))).otherwise(F.col("sheet")).alias("to_sheet"),
        part(2).cast("bigint").alias("r"), _column(part(1)).cast("bigint").alias("c"), F.when(part(4) != "", part(4)).cast("bigint").alias("s"), F.when(part(3) != "", _column(part(3))).cast("bigint").alias("d"),
    )
    r, c, s, d = (F.col(x) for x in "rcsd")
    s, d = F.coalesce(s, r), F.coalesce(d, c)
    return split.select("file", "sheet", "row", "col", "to_sheet", F.least(r, s).alias("r1"), F.least(c, d).alias("c1"), F.greatest(r, s).alias("r2"), F.greatest(c, d).alias("c2"))


def names_used(cells: DataFrame) -> DataFrame:
    """(file, sheet, row, col, name) of the words in formulas that are no cells, functions, sheets or truth values."""
    bare = F.regexp_replace(_bare(F.col("formula")), f"({REFERENCE})|({_SHEET})", " ")
    found = cells.where(F.col("formula").isNotNull()).select("file", "sheet", "row", "col", F.explode(F.array_distinct(F.regexp_extract_all(bare, F.lit(f"({NAME})"), F.lit(1)))).alias("name"))
    return found.where(~F.upper("name").isin("TRUE", "FALSE"))


def missing_sheets(cells: DataFrame, sheets: DataFrame) -> DataFrame:
    """(file, sheet, row, col, to_sheet) of formulas that name a sheet the file has not; names without case."""
    used = F.explode(F.array_distinct(F.regexp_extract_all(_bare(F.col("formula")), F.lit(f"({SHEET_USE})"), F.lit(1))))
    uses = cells.where(F.col("formula").isNotNull()).select("file", "sheet", "row", "col", used.alias("t")).withColumn("to_sheet", sheet_name(F.col("t"))).drop("t")
    known = sheets.select(F.col("file").alias("f"), F.lower("sheet").alias("s"))
    return uses.join(known, (F.col("file") == F.col("f")) & (F.lower("to_sheet") == F.col("s")), "left_anti")


def column_sums(cells: DataFrame, ranges: DataFrame) -> DataFrame:
    """``ranges`` (key, file, to_sheet, r1, c1, r2, c2) with ``total`` and ``numbers`` of the stored numbers in each.

    Every column of a range is the difference of two running totals, looked up at its ends, so a range costs
    two rows a column however long it is. Totals are decimals of nine places; larger numbers give NULL.
    """
    by = ["file", "to_sheet", "c"]
    stored = cells.where(F.col("num").isNotNull()).select("file", F.lower("sheet").alias("to_sheet"), F.col("col").alias("c"), F.col("row").alias("at"), F.col("num").try_cast("decimal(38,9)").alias("v"))
    running = staged(scan(stored, ["at"], {"sum": Fold("sum", F.col("v").cast("decimal(38,9)")), "count": Fold("count", F.lit(1))}, by).select(*by, "at", F.col("sum").cast("decimal(38,9)").alias("sum"), "count"), "running")
    ends = _ends(ranges)
    found = as_of(ends, "to", running, "at", ["sum", "count"], by, spread=True)
    zero = F.lit(0).cast("decimal(38,9)")
    amount = F.coalesce("sum", zero) * F.col("sign")
    summed = found.groupBy("key").agg(F.sum(amount).cast("double").alias("total"), F.sum(F.coalesce("count", F.lit(0)) * F.col("sign")).alias("numbers"))
    return ranges.join(summed, "key")


def _ends(ranges: DataFrame) -> DataFrame:
    column = ranges.select("key", "file", F.lower("to_sheet").alias("to_sheet"), "r1", "r2", F.explode(F.sequence("c1", "c2")).alias("c"))
    both = F.array(F.struct(F.lit(1).alias("sign"), F.col("r2").alias("to")), F.struct(F.lit(-1).alias("sign"), (F.col("r1") - 1).alias("to")))
    return column.select("key", "file", "to_sheet", "c", F.explode(both).alias("e")).select("key", "file", "to_sheet", "c", "e.*")


def stale_caches(cells: DataFrame, formulas: DataFrame | None = None) -> DataFrame:
    """(file, sheet, row, col, cached, computed) of formulas whose stored number is not what its cells give.

    Recomputed are formulas that are one reference, or SUM, COUNT or AVERAGE of one range, from the stored
    values of their cells; agreement is to 1e-9 of the larger number. Other formulas are not judged, nor those
    that ``formulas``, a part of the cells, leaves out.
    """
    simple = rf"(?i)^\s*(?:(SUM|COUNT|AVERAGE)\(\s*({REFERENCE})\s*\)|({REFERENCE}))\s*$"
    judged = (cells if formulas is None else formulas).where((F.col("kind") == "number") & F.rlike("formula", F.lit(simple)))
    judged = judged.withColumn("key", F.concat_ws("\u0001", "file", "sheet", "row", "col")).withColumn("how", F.upper(F.regexp_extract("formula", simple, 1)))
    ranges = references(judged).withColumn("key", F.concat_ws("\u0001", "file", "sheet", "row", "col"))
    sums = column_sums(cells, ranges).select("key", "total", "numbers")
    both = judged.select("key", "file", "sheet", "row", "col", "how", F.col("num").alias("cached")).join(sums, "key")
    value = F.when(F.col("how") == "COUNT", F.col("numbers").cast("double")).when(F.col("how") == "AVERAGE", F.try_divide("total", "numbers")).otherwise(F.col("total"))
    out = both.withColumn("computed", value).where("computed is not null")
    apart = F.abs(F.col("cached") - F.col("computed")) > 1e-9 * F.greatest(F.abs("cached"), F.abs("computed"), F.lit(1.0))
    return out.where(apart).select("file", "sheet", "row", "col", "cached", "computed")


def formula_edges(cells: DataFrame) -> DataFrame:
    """(file, sheet, row, col, to_sheet, to_row, to_col): formulas whose ranges hold other formulas.

    Joined by the column within a range's width; rows are compared in the join.
    """
    refs = references(cells).select("*", F.explode(F.sequence("c1", "c2")).alias("to_col"))
    heads = cells.where(F.col("formula").isNotNull()).select("file", F.lower("sheet").alias("h_sheet"), F.col("sheet").alias("h_name"), F.col("row").alias("to_row"), F.col("col").alias("to_col"))
    joined = refs.withColumn("h_sheet", F.lower("to_sheet")).join(heads, ["file", "h_sheet", "to_col"]).where(F.col("to_row").between(F.col("r1"), F.col("r2")))
    return joined.select("file", "sheet", "row", "col", F.col("h_name").alias("to_sheet"), "to_row", "to_col").distinct()


def circular_cells(cells: DataFrame, rounds: int = 100) -> DataFrame:
    """(file, sheet, row, col) of formulas on a circle of references, or between two.

    A circle has a reference that does not lead up or left; sheets without one are done at once. In the
    others, references to cells that lead nowhere, and from cells that nothing leads to, go round by round;
    each round is written to the shared folder. Chains of more than ``rounds`` cells are an error.
    """
    edges = staged(formula_edges(cells), "edges")
    ahead = (F.col("to_sheet") != F.col("sheet")) | (F.col("to_row") > F.col("row")) | ((F.col("to_row") == F.col("row")) & (F.col("to_col") >= F.col("col")))
    edges = edges.join(edges.where(ahead).select("file").distinct(), "file", "left_semi")
    n = edges.count()
    for _ in range(rounds):
        if not n:
            break
        sources = edges.select("file", F.col("sheet").alias("to_sheet"), F.col("row").alias("to_row"), F.col("col").alias("to_col")).distinct()
        edges_in = edges.join(sources, ["file", "to_sheet", "to_row", "to_col"], "left_semi")
        targets = edges_in.select("file", F.col("to_sheet").alias("sheet"), F.col("to_row").alias("row"), F.col("to_col").alias("col")).distinct()
        edges = staged(edges_in.join(targets, ["file", "sheet", "row", "col"], "left_semi").select("file", "sheet", "row", "col", "to_sheet", "to_row", "to_col"), "edges")
        left = edges.count()
        if left == n:
            break
        n = left
    else:
        raise ValueError(f"references form chains of over {rounds} cells")
    return edges.select("file", "sheet", "row", "col").distinct()


def workbook_issues(cells: DataFrame, sheets: DataFrame, names: DataFrame, circles: bool = True) -> DataFrame:
    """(subtype, severity, path, message) of all cells and defined names.

    ``cells`` are those of the workbook source, ``sheets`` (file, sheet), ``names`` (file, name, refers). A
    formula with a missing sheet counts as that alone; errors and missing values are named after it.
    """
    place = F.concat(F.col("sheet"), F.lit("!R"), F.col("row").cast("string"), F.lit("C"), F.col("col").cast("string"))
    missing = missing_sheets(cells, sheets)
    gone = missing.groupBy("file", "sheet", "row", "col").agg(F.array_join(F.array_sort(F.collect_set("to_sheet")), ", ").alias("message"))
    formulas = cells.where(F.col("formula").isNotNull()).join(gone.select("file", "sheet", "row", "col"), ["file", "sheet", "row", "col"], "left_anti")
    parts = [
        gone.select(F.lit("formula_ref_missing_sheet").alias("subtype"), "file", place.alias("path"), "message"),
        formulas.where("kind = 'error'").select(F.lit("formula_eval_error").alias("subtype"), "file", place.alias("path"), F.col("text").alias("message")),
        formulas.where("kind = 'blank'").select(F.lit("formula_not_evaluated").alias("subtype"), "file", place.alias("path"), F.concat(F.lit("="), F.col("formula")).alias("message")),
        stale_caches(cells, formulas).select(F.lit("formula_cache_stale").alias("subtype"), "file", place.alias("path"), F.concat(F.col("cached").cast("string"), F.lit(" for "), F.col("computed").cast("string")).alias("message")),
    ]
    broken = F.contains("refers", F.lit("#REF!"))
    parts.append(names.where(broken).select(F.lit("definedname_broken").alias("subtype"), "file", F.col("name").alias("path"), F.col("refers").alias("message")))
    as_cells = names.where(~broken).select("file", F.col("name").alias("sheet"), F.lit(0).alias("row"), F.lit(0).alias("col"), F.col("refers").alias("formula"))
    lost = missing_sheets(as_cells, sheets).groupBy("file", "sheet").agg(F.array_join(F.array_sort(F.collect_set("to_sheet")), ", ").alias("message"))
    parts.append(lost.select(F.lit("definedname_target_missing").alias("subtype"), "file", F.col("sheet").alias("path"), "message"))
    if circles:
        parts.append(circular_cells(cells).select(F.lit("formula_circular").alias("subtype"), "file", place.alias("path"), F.lit("refers to itself").alias("message")))
    severity = F.create_map(*[F.lit(x) for kv in SEVERITY.items() for x in kv])
    return reduce(DataFrame.unionByName, parts).select("subtype", F.try_element_at(severity, F.col("subtype")).alias("severity"), "file", "path", "message")
