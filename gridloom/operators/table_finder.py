"""Tables among the cells of sheets, found by joins on neighbouring places, so that a sheet is spread over many tasks.

Cells are cut into runs, along rows for the headers and along columns for the bodies. A body grows from run
to run: the next row below what it reaches is looked up in each of its columns, and the furthest end found
is its new reach. What is repeated round by round are the tables still growing, not the cells.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridloom.functions.ordered import Fold, scan
from gridloom.staging import staged

_NUMBER = r"^\s*[-+$(]?\s*(\d[\d,]*\.?\d*|\.\d+)([eE][-+]?\d+)?\)?\s*$"


def detect_tables(cells: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Keys, first_row, first_col, columns, rows (below the header) and header of each table among cells.

    ``cells`` have row, col and text, and formula if formulas matter; sheets are told apart by ``keys``, by
    default file and sheet where there are such columns. A table begins at a text that is no number and no
    formula, with nothing above it and nothing to its left; its header are the filled cells from there to
    the right, two at least; it ends above the first row that is blank below the header, and has a row at
    least. A table that would begin within an earlier one is part of that. NULL and empty texts are blank;
    of cells at one place one counts. Bodies are followed when the plan is made, a job for each round.
    """
    keys = [c for c in ("file", "sheet") if c in cells.columns] if keys is None else list(keys)
    formula = F.col("formula").isNotNull() if "formula" in cells.columns else F.lit(False)
    word = ~F.rlike("text", F.lit(_NUMBER)) & ~formula
    filled = cells.where(F.coalesce(F.col("text"), F.lit("")) != "").groupBy(*keys, F.col("row").cast("bigint").alias("row"), F.col("col").cast("bigint").alias("col"))
    cell = staged(filled.agg(F.min(F.struct(F.col("text"), word.alias("word"))).alias("c")).select(*keys, "row", "col", "c.*"), "cells")
    place = [*keys, "row", "col"]
    below, right = cell.select(*keys, (F.col("row") + 1).alias("row"), "col"), cell.select(*keys, "row", (F.col("col") + 1).alias("col"))
    anchors = cell.where("word").select(*place).join(below, place, "left_anti").join(right, place, "left_anti")
    heads = _headers(cell, anchors, keys)
    runs = scan(cell.select(*place), ["row"], {"run": Fold("count", F.lit(1))}, [*keys, "col"]).withColumn("run", F.col("row") - F.col("run"))
    ends = runs.join(runs.groupBy(*keys, "col", "run").agg(F.max("row").alias("end")), [*keys, "col", "run"]).select(*place, "end")
    blocks = _grown(staged(heads, "headers"), staged(ends, "runs"), keys)
    kept = _claimed(blocks, keys)
    return kept.select(*keys, F.col("row").alias("first_row"), F.col("col").alias("first_col"), (F.col("last") - F.col("col") + 1).alias("columns"), (F.col("reach") - F.col("row")).alias("rows"), "header")


def _headers(cell: DataFrame, anchors: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, row, col, last, header): runs of two cells or more that begin at an anchor."""
    rows = cell.join(anchors.select(*keys, "row").distinct(), [*keys, "row"], "left_semi")
    run = F.col("col") - F.row_number().over(Window.partitionBy(*keys, "row").orderBy("col"))
    whole = rows.withColumn("run", run).groupBy(*keys, "row", "run").agg(F.min("col").alias("col"), F.max("col").alias("last"), F.array_sort(F.collect_list(F.struct("col", "text"))).alias("h"))
    return whole.where("last > col").join(anchors, [*keys, "row", "col"], "left_semi").select(*keys, "row", "col", "last", F.transform("h", lambda x: x["text"]).alias("header"))


def _grown(heads: DataFrame, ends: DataFrame, keys: list[str]) -> DataFrame:
    """``heads`` with ``reach``, the last row of each body; those without a body are left out."""
    block = [*keys, "row", "col"]
    reached = heads.select(*block, "last", F.col("row").alias("reach"))
    growing = reached
    while True:
        steps = growing.select(*keys, F.col("row").alias("__r"), F.col("col").alias("__c"), "last", F.explode(F.sequence("col", "last")).alias("col"), (F.col("reach") + 1).alias("row"))
        found = steps.join(ends, [*keys, "row", "col"]).groupBy(*keys, "__r", "__c", "last").agg(F.max("end").alias("reach"))
        growing = staged(found.select(*keys, F.col("__r").alias("row"), F.col("__c").alias("col"), "last", "reach"), "growing")
        if growing.isEmpty():
            break
        reached = reached.unionByName(growing)
    furthest = reached.groupBy(*block).agg(F.max("reach").alias("reach"))
    return staged(heads.join(furthest, block).where(F.col("reach") > F.col("row")), "bodies")


def _claimed(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """Blocks that begin within no earlier one that is kept."""
    block = [*keys, "row", "col"]

    def within(some: DataFrame, others: DataFrame) -> DataFrame:
        """(keys, row, col) of ``some`` whose first cell lies in one of ``others`` that begins above."""
        spans = others.select(*keys, F.explode(F.sequence("col", "last")).alias("col"), "row", F.col("reach").alias("__end"), F.lit(False).alias("__asked"))
        both = spans.unionByName(some.select(*block, F.lit(None).cast("bigint").alias("__end"), F.lit(True).alias("__asked")))
        before = Window.partitionBy(*keys, "col").orderBy("row").rangeBetween(Window.unboundedPreceding, -1)
        return both.withColumn("__far", F.max("__end").over(before)).where(F.col("__asked") & (F.col("__far") >= F.col("row"))).select(*block)

    kept, open_ = blocks.limit(0), blocks
    while not open_.isEmpty():
        free = staged(open_.join(within(open_, open_.unionByName(kept)), block, "left_anti"), "kept")
        kept = kept.unionByName(free)
        rest = open_.join(free.select(*block), block, "left_anti")
        open_ = staged(rest.join(within(rest, kept), block, "left_anti"), "open")
    return kept
