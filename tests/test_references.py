"""Issues of workbooks by their references."""

import random
import re

import pytest

from gridloom.operators import references
from gridloom.sources import workbook
from gridloom.sources.ooxml import write_package

CELLS = "file string, sheet string, row bigint, col bigint, kind string, num double, text string, formula string"


def cells(spark, rows):
    made = []
    for file, sheet, ref, value, formula in rows:
        m = re.fullmatch(r"([A-Z]+)(\d+)", ref)
        kind = "blank" if value is None else "error" if str(value).startswith("#") else "string" if isinstance(value, str) else "number"
        made.append((file, sheet, int(m[2]), sum((ord(c) - 64) * 26**i for i, c in enumerate(reversed(m[1]))), kind, float(value) if kind == "number" else None, None if value is None else str(value), formula))
    return spark.createDataFrame(made, CELLS)


def test_references_are_cut_out_of_formulas(spark):
    texts = ["A1+$B$2*Sheet2!C3", "SUM(A1:B10)", "'my ''sheet'!AA10:$AB$2", '"A1"&B2', "LOG10(A1)+A1B2+x.A1", "Rate*A1+TRUE+Other!Z9", "Sheet1!A1:A3", "R2D2(A1)+_x", "a1"]
    df = cells(spark, [("f", "S", f"A{i + 1}", 1, t) for i, t in enumerate(texts)])
    got = {}
    for r in references.references(df).collect():
        got.setdefault(r.row - 1, []).append((r.to_sheet, r.c1, r.r1, r.c2, r.r2))
    assert {k: sorted(v) for k, v in got.items()} == {
        0: [("S", 1, 1, 1, 1), ("S", 2, 2, 2, 2), ("Sheet2", 3, 3, 3, 3)], 1: [("S", 1, 1, 2, 10)], 2: [("my 'sheet", 27, 2, 28, 10)], 3: [("S", 2, 2, 2, 2)],
        4: [("S", 1, 1, 1, 1)], 5: [("Other", 26, 9, 26, 9), ("S", 1, 1, 1, 1)], 6: [("Sheet1", 1, 1, 1, 3)], 7: [("S", 1, 1, 1, 1)], 8: [("S", 1, 1, 1, 1)],
    }
    names = {(r.row - 1, r.name) for r in references.names_used(df).collect()}
    assert {n for i, n in names if i == 5} == {"Rate"} and {n for i, n in names if i == 7} == {"_x"} and not {n for i, n in names if i in (0, 1, 2, 3)}


def test_one_case_of_each_subtype(spark):
    rows = [("f", "One", f"A{i}", i, None) for i in range(1, 6)]
    rows += [
        ("f", "One", "B1", 15, "SUM(A1:A5)"), ("f", "One", "B2", 16, "SUM(A1:A5)"), ("f", "One", "B3", 3, "AVERAGE(A1:A5)"), ("f", "One", "B4", 4, "COUNT(A1:A5)"), ("f", "One", "B5", 2, "A2"),
        ("f", "One", "B6", 9, "Gone!A1"), ("f", "One", "B7", "#DIV/0!", "A1/0"), ("f", "One", "B8", None, "A1+A2"), ("f", "One", "B9", "#REF!", "'no such'!A1"), ("f", "One", "B10", 0, "SUM(C1:D9)"),
        ("f", "Two", "A1", 1, "B1"), ("f", "Two", "B1", 1, "C1+one!A1"), ("f", "Two", "C1", 1, "A1"), ("f", "Two", "D1", 7, "A1*2"), ("f", "Two", "E5", 1, "E5"),
    ]
    rows += [("g", "One", "A1", 5, "SUM(B1:B2)"), ("g", "One", "B1", 2, None), ("g", "One", "B2", 3, "B1+1")]
    df = cells(spark, rows)
    sheets = spark.createDataFrame([("f", "One"), ("f", "Two"), ("g", "One")], "file string, sheet string")
    names = spark.createDataFrame([("f", "Good", "One!$A$1"), ("f", "Bad", "One!#REF!"), ("f", "Lost", "Gone!$A$1:$B$2"), ("g", "Odd", "Two!A1")], "file string, name string, refers string")
    got = {(r.subtype, r.file, r.path) for r in references.workbook_issues(df, sheets, names).collect()}
    at = lambda s, r, c: f"{s}!R{r}C{c}"
    assert got == {
        ("formula_cache_stale", "f", at("One", 2, 2)), ("formula_cache_stale", "f", at("One", 4, 2)), ("formula_ref_missing_sheet", "f", at("One", 6, 2)), ("formula_ref_missing_sheet", "f", at("One", 9, 2)),
        ("formula_eval_error", "f", at("One", 7, 2)), ("formula_not_evaluated", "f", at("One", 8, 2)), ("definedname_broken", "f", "Bad"), ("definedname_target_missing", "f", "Lost"), ("definedname_target_missing", "g", "Odd"),
        ("formula_circular", "f", at("Two", 1, 1)), ("formula_circular", "f", at("Two", 1, 2)), ("formula_circular", "f", at("Two", 1, 3)), ("formula_circular", "f", at("Two", 5, 5)),
    }


def test_range_sums_by_brute_force(spark):
    rng = random.Random(1)
    grid = {(r, c): rng.choice([None, rng.randint(-99, 99) / 4]) for r in range(1, 40) for c in range(1, 6)}
    df = spark.createDataFrame([("f", "S", r, c, "number", v, str(v), None) for (r, c), v in grid.items() if v is not None], CELLS)
    ranges = []
    for k in range(60):
        r1, r2 = sorted(rng.randint(1, 45) for _ in range(2))
        c1, c2 = sorted(rng.randint(1, 7) for _ in range(2))
        ranges.append((str(k), "f", "S", r1, c1, r2, c2))
    got = references.column_sums(df, spark.createDataFrame(ranges, "key string, file string, to_sheet string, r1 bigint, c1 bigint, r2 bigint, c2 bigint")).collect()
    for r in got:
        inside = [v for (y, x), v in grid.items() if v is not None and r.r1 <= y <= r.r2 and r.c1 <= x <= r.c2]
        assert (r.total, r.numbers) == (sum(inside), len(inside))
    assert len(got) == 60


def test_issues_of_a_written_workbook(spark, tmp_path):
    with open(tmp_path / "w.xlsx", "wb") as f:
        write_package(f, None, [(1, 2, "=Nowhere!A1"), (3, 4, "=A1+B1")], formulas=True, names={"Total": "Sheet1!$A$1", "Old": "#REF!$A$1"})
    where = str(tmp_path / "*.xlsx")
    sheets, names = workbook.read_parts(spark, where)
    got = {(r.subtype, r.path) for r in references.workbook_issues(workbook.read_workbooks(spark, where), sheets, names).collect()}
    assert got == {("formula_ref_missing_sheet", "Sheet1!R1C3"), ("formula_not_evaluated", "Sheet1!R2C3"), ("definedname_broken", "Old")}


def test_long_chains_are_refused_not_cut(spark):
    down = cells(spark, [("f", "S", f"A{i}", 1, f"A{i - 1}") for i in range(2, 300)])
    assert references.circular_cells(down).collect() == []
    up = cells(spark, [("f", "S", f"A{i}", 1, f"A{i + 1}") for i in range(1, 60)])
    with pytest.raises(ValueError, match="chains"):
        references.circular_cells(up, rounds=3)
