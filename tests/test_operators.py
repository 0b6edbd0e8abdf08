"""Pivots, lookups, selectors, ranges, profiles, sources and streams on small tables."""

import datetime as dt
import itertools
import random
import statistics

import pytest
from pyspark.sql import functions as F

from gridloom.functions import call
from gridloom.operators import batches, lookup, profile, ranges, selectors, table_finder
from gridloom.operators.pivot import Pivot, Value, ordered
from gridloom.sources import delimited, markup, workbook
from gridloom.streaming.windows import deduplicated, windowed

REGIONS, CATEGORIES, QUARTERS = ("North", "South", "East"), ("Food", "Clothing"), ("Q1", "Q2", "Q3")
SALES = [
    (r, c, q, None if (i % 11 == 3) else float((i * 37) % 101), "x" if i % 9 == 0 else str(i), dt.date(2024 + i % 2, 1 + i % 12, 5))
    for i, (r, c, q, _) in enumerate(itertools.product(REGIONS, CATEGORIES, QUARTERS, range(3)))
]


@pytest.fixture
def sales(spark):
    rows = [*SALES, ("", "Food", "Q1", 5.0, "1", None), (None, "Food", "Q1", 5.0, "1", None)]
    return spark.createDataFrame(rows, "region string, category string, quarter string, amount double, mixed string, day date")


def test_value_fields_are_parsed_from_the_right():
    assert Value.parse("a:b:sum:percent_of_row:Share") == Value("a:b", "sum", "percent_of_row", "Share")
    assert Value.parse("a:avg").how == "average" and Value.parse("a").alias == "Sum of a"
    with pytest.raises(ValueError):
        Value.parse("a:sum:difference")


def test_pivot_totals_re_aggregate_rows(sales):
    """S11, S12: totals of averages and deviations come from rows; rows without a key leave; text is not counted."""
    p = Pivot(["region", "category"], ["quarter"], ["amount:average::a", "amount:stdDev::sd", "mixed:count::n", "amount:product::p"])
    got = {(r.region, r.category, r.quarter, r.row_level, r.col_level): r for r in p.build(sales).collect()}
    for r, c, q in itertools.product((*REGIONS, None), (*CATEGORIES, None), (*QUARTERS, None)):
        if r is None and c is not None:
            continue
        rows = [s for s in SALES if r in (None, s[0]) and c in (None, s[1]) and q in (None, s[2])]
        values = [s[3] for s in rows if s[3] is not None]
        have = got[(r, c, q, (r is None) + (c is None), int(q is None))]
        assert have.a == pytest.approx(statistics.mean(values))
        assert have.sd == pytest.approx(statistics.stdev(values) if len(values) > 1 else 0)
        assert have.n == sum(s[4] != "x" for s in rows)
    assert len(got) == (6 + 3 + 1) * 4


def test_pivot_layout_choices(sales):
    none = Pivot(["region"], ["quarter"], ["amount"], grand_totals="none").build(sales)
    assert none.count() == 9
    rows = Pivot(["region"], ["quarter"], ["amount"], grand_totals="rows").build(sales)
    assert {(r.row_level, r.col_level) for r in rows.collect()} == {(0, 0), (0, 1)}
    top = Pivot(["region", "category"], values=["amount"], top_n=1, subtotals=False, grand_totals="none").build(sales)
    best = max(REGIONS, key=lambda r: sum(s[3] or 0 for s in SALES if s[0] == r))
    assert {r.region for r in top.collect()} == {best}
    starts = Pivot(["region"], values=["amount"], label_filter=("region", "beginsWith", "N"), grand_totals="none").build(sales)
    assert [r.region for r in starts.collect()] == ["North"]
    by_date = Pivot(["day:year", "day:quarter"], values=["amount:count::n"], grand_totals="none", subtotals=False).build(sales)
    assert {r.day_quarter for r in by_date.collect()} <= {"Qtr1", "Qtr2", "Qtr3", "Qtr4"}
    p = Pivot(["region"], values=["amount"])
    assert [r.region for r in ordered(p.build(sales), p).collect()] == ["East", "North", "South", None]


def test_exact_lookup_keeps_the_first_and_ignores_case(spark):
    left = spark.createDataFrame([("A",), ("b",), (None,), ("z",)], "k string")
    right = spark.createDataFrame([("a", 1, 0), ("a", 2, 1), ("B", None, 2), (None, 9, 3)], "k string, v int, o int")
    got = {r.k: r.v for r in lookup.exact(left, "k", right, "k", ["v"], "o", default={"v": -1}).collect()}
    assert got == {"A": 1, "b": None, None: -1, "z": -1}
    assert {r.k: r.v for r in lookup.exact(left, "k", right, "k", ["v"], "o", last=True).collect()}["A"] == 2


def test_as_of_lookups(spark):
    left = spark.createDataFrame([(g, x) for g in "ab" for x in (None, 0, 1, 2, 3, 9)], "g string, x int")
    right = spark.createDataFrame([("a", 1, 10), ("a", 3, 30), ("b", 2, 20)], "g string, t int, v int")
    back = {(r.g, r.x): r.v for r in lookup.as_of(left, "x", right, "t", ["v"], ["g"]).collect()}
    assert [back["a", x] for x in (None, 0, 1, 2, 3, 9)] == [None, None, 10, 10, 30, 30]
    ahead = {(r.g, r.x): r.v for r in lookup.as_of(left, "x", right, "t", ["v"], ["g"], "forward").collect()}
    assert [ahead["b", x] for x in (None, 0, 1, 2, 3, 9)] == [None, 20, 20, 20, None, None]


MIXED = [3.0, "3", "abc", "ABC", "", None, "TRUE", "-1.5", "50%", "2cm"]


def test_typed_sort_keeps_blanks_last(spark):
    df = spark.createDataFrame([(i, None if v is None else str(v)) for i, v in enumerate(["10", "9", "b", None, "A", ""])], "o int, v string")
    assert [r.v for r in ranges.sort_rows(df, "v asc", "o").collect()] == ["9", "10", "A", "b", None, ""]
    assert [r.v for r in ranges.sort_rows(df, "v desc", "o").collect()] == ["10", "9", "b", "A", None, ""]


def test_selectors(spark):
    df = spark.createDataFrame([(1, "Ann", 5200.0, "Sales", "12pt", "#FF0000"), (2, "Bob", None, "Dev", "1in", "ff0000"), (3, "Cy", 100.0, None, "72pt", "00FF00")], "id int, name string, Salary double, Dept string, size string, fill string")
    ids = lambda s: [r.id for r in selectors.where_rows(df, s).orderBy("id").collect()]
    assert ids("row[Salary>5000 or Salary<200]") == [1, 3]
    assert ids("row[not(salary > 200)]") == [2, 3]
    assert ids("row[Dept!=Sales]") == [2, 3]
    assert ids("row[size=1in]") == [2, 3]
    assert ids("row[fill=#ff0000][id<=1]") == [1]
    assert ids("row[Dept=Sales],row[A=1],row[col.name~=y]") == [1, 3]
    assert ids('Sheet1!row[name ~= r"^b" and (Dept)]') == [2]
    with pytest.raises(selectors.SelectorError, match="Salary"):
        ids("row[salery>1]")
    with pytest.raises(selectors.SelectorError):
        ids("row[(id=1]")


def test_node_selectors(spark):
    rows = [("/b", "/", 1, "body", None), ("/b/p1", "/b", 1, "paragraph", "one"), ("/b/p2", "/b", 2, "paragraph", ""), ("/b/p1/r1", "/b/p1", 1, "run", "one")]
    nodes = spark.createDataFrame([(*r, "Normal", {"font": "Arial"}) for r in rows], "path string, parent_path string, ord int, type string, text string, style string, format map<string,string>")
    paths = lambda s: sorted(r.path for r in selectors.select_nodes(nodes, s).collect())
    assert paths("paragraph[style=Normal] > run[font!=Times]") == ["/b/p1/r1"]
    assert paths("paragraph[last()], paragraph:empty") == ["/b/p2"]
    assert paths("paragraph[1]:contains(ON)") == ["/b/p1"]


def test_filters_formats_and_validation(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([42, 58, 91, 73, 30, 88, 65, 100, 12, 77])], "i int, v double")
    v = F.col("v")
    assert {r.v for r in ranges.autofilter(df, {"v": [("top", 3)]}).collect()} == {100.0, 91.0, 88.0}
    assert {r.v for r in ranges.autofilter(df, {"v": [("bottomPercent", 20)]}).collect()} == {12.0, 30.0}
    assert {r.v for r in ranges.autofilter(df, {"v": [("lt", 20), ("gt", 95)], "i": [("gte", 8)]}).collect()} == {12.0}
    flags = ranges.flag_average(ranges.flag_top(df, "v", 25, percent=True, flag="t"), "v", deviations=1, flag="a").withColumn("b", ranges.cell_is(v, "between", 50, 70))
    for build in (lambda: ranges.top_flag(v, 3), lambda: ranges.average_flag(v), lambda: call("RANK", v)):
        with pytest.raises(ValueError, match="one task"):
            build()
    got = flags.collect()
    assert {r.v for r in got if r.t} == {100.0, 91.0} and {r.v for r in got if r.b} == {58.0, 65.0} and {r.v for r in got if r.a} == {91.0, 100.0}
    cells = spark.createDataFrame([("Draft",), ("draft ",), ("",), (None,), ("7",), ("7.5",)], "x string")
    x = F.col("x")
    good = cells.select(ranges.valid(x, "list", a=["Draft", "Done"]).alias("l"), ranges.valid(x, "whole", "between", 1, 9).alias("w"), ranges.valid(x, "textLength", "lessThanOrEqual", b=None, a=3, blank_ok=False).alias("t")).collect()
    assert [r.l for r in good] == [True, False, True, True, False, False]
    assert [r.w for r in good] == [False, False, True, True, True, False]
    assert [r.t for r in good] == [False, False, False, False, True, True]


def test_profiles_and_templates(spark):
    df = spark.createDataFrame([(1, "5", " a"), (2, "#N/A", None), (3, "=A1", "b"), (4, "2024-01-05", "TRUE")], "id int, x string, y string")
    p = {r["column"]: r for r in profile.profile(df).collect()}
    assert (p["x"].number, p["x"].error, p["x"].formula, p["x"].date, p["y"].blank, p["y"].boolean) == (1, 1, 1, 1, 1, 1)
    found = {(r.issue, r.id) for r in profile.cell_issues(df, "id").collect()}
    assert found == {("number_as_text:x", 1), ("padded:y", 1), ("error_value:x", 2), ("missing:y", 2)}
    j = spark.createDataFrame([('{"a": {"b": 1}, "c": [5, 6]}',)], "j string")
    assert {(r.key, r.value) for r in profile.flatten_json(j, "j", "a struct<b:int>, c array<int>").collect()} == {("a.b", "1"), ("c[0]", "5"), ("c[1]", "6")}
    done = batches.apply_steps(df, [{"op": "set", "column": "y", "value": "'z'", "where": "id = 1"}, {"op": "remove", "where": "id > 2"}, {"op": "rename", "column": "y", "to": "w"}])
    assert [(r.id, r.w) for r in done.orderBy("id").collect()] == [(1, "z"), (2, None)]
    with pytest.raises(ValueError):
        batches.apply_steps(df, [{"op": "explode"}])


def test_delimited_text(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('name,v,d\n"a, ""b""\nc",12345678901234567,2024-01-05\nx,true,\ny,=A1+1,1e3\n')
    df = delimited.read_delimited(spark, str(path))
    assert df.count() == 3 and df.first().name == 'a, "b"\nc'
    kinds = delimited.typed(df).select("v.kind", "v.bool", "v.formula", "v.str").collect()
    assert [k.kind for k in kinds] == ["number", "boolean", "formula"] and kinds[0].str == "12345678901234567" and kinds[2].formula == "A1+1"
    assert {r["column"]: r.kind for r in delimited.column_types(df).collect()} == {"name": "string", "v": "string", "d": "string"}


def test_workbooks(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(workbook.write_workbook([("x", 1.5, True), ("<&>", None, False)], ["name", "n", "ok"]))
    cells = workbook.read_workbooks(spark, str(tmp_path / "*.xlsx")).cache()
    got = {(r.row, r.col): (r.kind, r.text if r.kind != "number" else r.num) for r in cells.collect()}
    assert got[(2, 2)] == ("number", 1.5) and got[(3, 1)] == ("string", "<&>") and got[(2, 3)] == ("boolean", "TRUE")
    wide = workbook.sheet_table(cells, "Sheet1", ["name", "n", "ok"]).orderBy("row").collect()
    assert [(r.name, r.n) for r in wide] == [("x", "1.5"), ("<&>", None)]
    tables = table_finder.detect_tables(cells.select("sheet", "row", "col", "text")).collect()
    assert [(t.first_row, t.columns, t.rows, t.header) for t in tables] == [(1, 3, 2, ["name", "n", "ok"])]


def test_markup(spark):
    text = "# Title\n\nSome text\ngoes on\n- item\n  - sub\n```py\ncode\n```\n| a | b |\n|---|---|\n| 1 | 2 |"
    rows = markup.markdown_blocks(spark.createDataFrame([(1, text)], "id int, body string"), "body", ["id"]).orderBy("ord").collect()
    assert [(r.kind, r.level) for r in rows] == [("heading", 1), ("paragraph", 0), ("item", 1), ("item", 2), ("code", 0), ("header", 0), ("row", 0)]
    graph = "graph TD\nA[Start] --> B{Choice}\nB -->|yes| C((End))\n"
    parts = markup.diagram_parts(spark.createDataFrame([(1, graph)], "id int, g string"), "g", ["id"]).collect()
    assert {(r.source, r.target, r.label) for r in parts if r.part == "edge"} == {("A", "B", ""), ("B", "C", "yes")}
    assert {(r.source, r.target) for r in parts if r.part == "node"} == {("A", "Start"), ("B", "Choice"), ("C", "End")}


def test_stream_equals_batch(spark, tmp_path):
    rows = [(i, dt.datetime(2024, 1, 1, i % 5, 10), "a" if i % 2 else "b", float(i)) for i in range(40)]
    spark.createDataFrame(rows, "id long, ts timestamp, k string, v double").repartition(3).write.parquet(str(tmp_path / "in"))
    values = {"total": ("sum", "v"), "n": ("count", "v")}
    batch = spark.read.parquet(str(tmp_path / "in"))
    expected = sorted(map(tuple, windowed(batch, ["k"], values, "1 hour").collect()))
    stream = spark.readStream.schema(batch.schema).parquet(str(tmp_path / "in"))
    q = windowed(stream, ["k"], values, "1 hour", late="1 day").writeStream.outputMode("complete").format("memory").queryName("w").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    q.awaitTermination(60)
    assert sorted(map(tuple, spark.table("w").collect())) == expected
    assert deduplicated(batch, ["k"]).count() == 2


def test_long_scan(spark):
    got = spark.range(1).select(call("SCAN", F.lit(0).cast("bigint"), F.sequence(F.lit(1), F.lit(100_000)).cast("array<bigint>"), lambda a, x: a + x).alias("s")).first().s
    assert len(got) == 100_000 and got[-1] == 100_000 * 100_001 // 2 and got[:3] == [1, 3, 6]
    odd = spark.sql("SELECT array(cast(3 as bigint)) AS one, cast(array() AS array<bigint>) AS none, cast(NULL AS array<bigint>) AS missing")
    add = lambda x: call("SCAN", F.lit(10).cast("bigint"), F.col(x), lambda a, e: a * e)
    assert tuple(odd.select(*[add(x) for x in odd.columns]).first()) == ([30], [], None)


def test_as_of_over_all_rows_equals_one_group(spark):
    left = spark.range(300).select((F.col("id") * 7 % 50).alias("x"), "id")
    left = left.unionByName(spark.createDataFrame([(None, 999)], "x bigint, id bigint"))
    right = spark.range(40).select((F.col("id") * 3 % 45).alias("t"), "id", F.lit("v").alias("v")).withColumn("one", F.lit(1))
    for direction in ("backward", "forward"):
        whole = lookup.as_of(left, "x", right.withColumnRenamed("id", "rid"), "t", ["rid"], None, direction, "rid")
        grouped = lookup.as_of(left.withColumn("one", F.lit(1)), "x", right.withColumnRenamed("id", "rid"), "t", ["rid"], ["one"], direction, "rid")
        spread = lookup.as_of(left.withColumn("one", F.lit(1)), "x", right.withColumnRenamed("id", "rid"), "t", ["rid"], ["one"], direction, "rid", spread=True)
        want = sorted(map(tuple, grouped.select("id", "x", "rid").collect()), key=repr)
        assert sorted(map(tuple, whole.select("id", "x", "rid").collect()), key=repr) == want == sorted(map(tuple, spread.select("id", "x", "rid").collect()), key=repr)


def test_selectors_over_several_files(spark):
    """Nodes of equal paths in several files: none is lost, and steps stay in their file."""
    rows = []
    for file in ("f1", "f2", "f3"):
        rows += [(file, "/b", "/", 1, "body", None), (file, "/b/p1", "/b", 1, "paragraph", f"{file} one"), (file, "/b/t1", "/b", 2, "table", None), (file, "/b/t1/p1", "/b/t1", 1, "paragraph", "deep"), (file, "/b/t1/p1/r1", "/b/t1/p1", 1, "run", "deep")]
        if file != "f2":
            rows += [(file, "/b/p2", "/b", 3, "paragraph", "two")]
    df = spark.createDataFrame([(*r, None, {}) for r in rows], "file string, path string, parent_path string, ord int, type string, text string, style string, format map<string,string>")
    trees = selectors.label_nodes(df).cache()
    assert {(r.path, r.pre, r.post, r.depth) for r in trees.where("file = 'f1'").collect()} == {("/b", 0, 5, 0), ("/b/p1", 1, 1, 1), ("/b/t1", 2, 4, 1), ("/b/t1/p1", 3, 4, 2), ("/b/t1/p1/r1", 4, 4, 3), ("/b/p2", 5, 5, 1)}
    for spread in (False, True):
        found = lambda s: sorted((r.file, r.path) for r in selectors.select_nodes(trees, s, spread=spread).collect())
        files = lambda p, skip=(): [(f, p) for f in ("f1", "f2", "f3") if f not in skip]
        assert found("body > paragraph[2]") == files("/b/p2", ["f2"])
        assert found("/body/paragraph[1]") == files("/b/p1") == found('paragraph[text~="one"]')
        assert found("table//run") == found("table run") == found("//table/paragraph/run[last()]") == files("/b/t1/p1/r1")
        assert found("body//paragraph[last()]") == sorted(files("/b/p2", ["f2"]) + [("f2", "/b/p1")] + files("/b/t1/p1"))
        assert found("run, table > paragraph, run:contains(deep)") == sorted(files("/b/t1/p1") + files("/b/t1/p1/r1"))
        assert found("paragraph paragraph") == [] and found("/paragraph") == []
    for wrong in ("a > > b", "> a", "a >", "", "a/[1"):
        with pytest.raises(selectors.SelectorError):
            selectors.select_nodes(trees, wrong)
    with pytest.raises(selectors.SelectorError, match="label_nodes"):
        selectors.select_nodes(df, "a//b")
    with pytest.raises(ValueError, match="cycle"):
        selectors.label_nodes(spark.createDataFrame([("f", "/a", "/", 1), ("f", "/b", "/c", 1), ("f", "/c", "/b", 1)], "file string, path string, parent_path string, ord int"))


def test_steps_move_swap_and_copy(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "i int, s string, x double")
    steps = [{"op": "copy", "column": "i", "to": "j"}, {"op": "move", "column": "j", "before": "s"}, {"op": "swap", "columns": ["i", "x"]}, {"op": "move", "column": "s", "to": 0}]
    out = batches.apply_steps(df, steps)
    assert out.columns == ["s", "i", "j", "x"] and tuple(out.first()) == ("a", 2.0, 1, 1)
    for wrong in ([{"op": "move", "column": "nope", "to": 0}], [{"op": "drop", "column": "s"}, {"op": "swap", "columns": ["s", "i"]}], [{"op": "fly"}], [{"op": "move", "column": "s", "before": "q"}]):
        with pytest.raises(ValueError):
            batches.apply_steps(df, wrong)


def test_replay_by_plain_python(spark):
    rng = random.Random(5)
    base = {k: (f"b{k}", None if k % 3 == 0 else k) for k in range(10)}
    log = [(i, rng.choice(["add", "set", "set", "remove"]), rng.randrange(14), rng.choice([None, f"s{i}"]), rng.choice([None, i])) for i in range(60)]
    state = dict(base)
    for _, op, k, s, x in log:
        if op == "add":
            state[k] = (s, x)
        elif op == "remove":
            state.pop(k, None)
        elif k in state:
            state[k] = tuple(old if new is None else new for old, new in zip(state[k], (s, x)))
    df = spark.createDataFrame([(k, *v) for k, v in base.items()], "k int, s string, x int")
    steps = spark.createDataFrame(log, "seq int, op string, k int, s string, x int")
    assert {r.k: (r.s, r.x) for r in batches.replay(df, steps, ["k"], "seq").collect()} == state
    dumped = batches.dump_rows(df, ["k"]).withColumn("seq", F.lit(1))
    parsed = batches.parsed_steps(dumped.unionByName(spark.createDataFrame([("junk", 1), ('{"op":"fly"}', 1)], "step string, seq int")), "k int, s string, x int", ["k"], "seq")
    assert {r.k: (r.s, r.x) for r in batches.replay(df.limit(0), parsed, ["k"], "seq").collect()} == base


def test_next_larger_key_reads_no_group_anew_for_each_row(spark):
    left = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("a", 2.5), ("a", 9.0), ("b", 0.0), (None, 1.0), ("a", None)], "g string, x double").withColumn("id", F.monotonically_increasing_id())
    right = spark.createDataFrame([("a", 1.0, 0), ("a", 3.0, 1), ("a", 3.0, 2), ("b", 5.0, 3), (None, 4.0, 4)], "g string, k double, ord int")
    large = lookup.position(left, "x", right, "k", "ord", 1, True, by=["g"])
    assert sorted(((r.g or "", r.x or 0.0, r.position) for r in large.collect()), key=repr) == sorted([("a", 1.0, 1), ("a", 1.0, 1), ("a", 2.5, 3), ("a", 9.0, None), ("b", 0.0, 4), ("", 1.0, 5), ("a", 0.0, None)], key=repr)
    small = lookup.position(left, "x", right, "k", "ord", -1, by=["g"], name="small")
    assert {(r.g, r.x): r.small for r in small.collect()} == {("a", 1.0): 1, ("a", 2.5): 1, ("a", 9.0): 2, ("b", 0.0): None, (None, 1.0): None, ("a", None): None}
    ahead = lookup.as_of(left, "x", right, "k", ["ord"], ["g"], "forward", "ord")
    assert {(r.g, r.x): r.ord for r in ahead.collect()} == {("a", 1.0): 0, ("a", 2.5): 1, ("a", 9.0): None, ("b", 0.0): 3, (None, 1.0): 4, ("a", None): None}
    for df in (large, ahead):
        assert "unboundedfollowing" not in df._jdf.queryExecution().optimizedPlan().toString().lower()
