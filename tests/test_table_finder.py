"""Detected tables against a plain scan of small grids."""

import random

from pyspark.sql import functions as F

from gridloom.operators.table_finder import detect_tables


def plain(grid):
    """grid: {(row, col): text}."""
    out, claimed = [], set()
    for r, c in sorted(grid):
        if (r, c) in claimed or grid[r, c][0].isdigit() or (r - 1, c) in grid or (r, c - 1) in grid:
            continue
        last, end = c, r
        while (r, last + 1) in grid:
            last += 1
        while any((end + 1, k) in grid for k in range(c, last + 1)):
            end += 1
        if last > c and end > r:
            claimed |= {(y, x) for y in range(r, end + 1) for x in range(c, last + 1)}
            out.append((r, c, last - c + 1, end - r, tuple(grid[r, k] for k in range(c, last + 1))))
    return out


def test_small_grids_by_brute_force(spark):
    rng = random.Random(12)
    grids = {}
    for k in range(80):
        share, rows, cols = rng.choice([0.3, 0.6, 0.85]), rng.randint(1, 12), rng.randint(1, 9)
        grids[f"s{k}"] = {(r, c): rng.choice(["a", "b", "7"]) for r in range(1, rows) for c in range(1, cols) if rng.random() < share}
    cells = [(s, r, c, t) for s, g in grids.items() for (r, c), t in g.items()] + [("s1", 90, 1, ""), ("s1", 90, 2, None)]
    got = {}
    for t in detect_tables(spark.createDataFrame(cells, "sheet string, row int, col int, text string")).collect():
        got.setdefault(t.sheet, []).append((t.first_row, t.first_col, t.columns, t.rows, tuple(t.header)))
    assert {s: sorted(v) for s, v in got.items()} == {s: sorted(plain(g)) for s, g in grids.items() if plain(g)}
    assert sum(map(len, got.values())) > 40


def test_formulas_are_no_headers_and_files_stay_apart(spark):
    rows = [(f, 1, c, t, None) for f in ("x", "y") for c, t in ((1, "a"), (2, "b"))] + [("x", 2, 1, "1", None), ("y", 2, 2, "2", None), ("z", 1, 1, "t", "A1"), ("z", 1, 2, "u", None), ("z", 2, 1, "1", None)]
    df = spark.createDataFrame(rows, "file string, row int, col int, text string, formula string").withColumn("sheet", F.lit("S"))
    assert sorted((t.file, t.rows) for t in detect_tables(df).collect()) == [("x", 1), ("y", 1)]
    assert detect_tables(df.limit(0)).collect() == []


def test_a_long_sheet_is_spread(spark):
    """One sheet of many rows: no task of the column runs holds a whole column."""
    cells = spark.range(1, 20_001).select(F.lit("S").alias("sheet"), F.col("id").alias("row"), F.explode(F.array(*[F.lit(i) for i in range(1, 6)])).alias("col"))
    cells = cells.withColumn("text", F.when(F.col("row") == 1, F.concat(F.lit("h"), F.col("col"))).otherwise(F.col("row").cast("string")))
    got = detect_tables(cells).collect()
    assert [(t.first_row, t.first_col, t.columns, t.rows, t.header) for t in got] == [(1, 1, 5, 19_999, ["h1", "h2", "h3", "h4", "h5"])]
