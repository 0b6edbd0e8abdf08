"""Patterns and criteria that come from tables, against plain Python."""

import random
import re

from pyspark.sql import functions as F

from gridloom.functions.text import wildcard_regex
from gridloom.operators.patterns import wildcard_counts, wildcard_lookup, wildcard_position


def words(rng, n):
    return [" ".join("".join(rng.choice("abc.X") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 3))) for _ in range(n)]


PATTERNS = ["*", "?", "???", "a*", "*a", "*ab*", "a?b*", "~*", "*~?*", "a.c", "A.X*", "", "zzz*", "*b c*", "[a]*", "x\\y", "~~*", "*~**", "ünï*", "*😀*", "a*b*c", "**", "?*?", None]


def test_patterns_by_brute_force(spark):
    rng = random.Random(2)
    texts = words(rng, 300) + ["a*", "what?", "[a]b", "x\\y", "~tilde", "", None, "ünïcode", "x😀y", "*", "a\nb"] + ["c" * 40_000 + "ab"]
    patterns = PATTERNS + [f"*{t[1:4]}*" for t in words(rng, 60)] + words(rng, 20) + ["*Ab"]
    left = spark.createDataFrame(list(enumerate(patterns)), "i int, p string").withColumn("text", F.lit("clash"))
    right = spark.createDataFrame([(k, t, f"v{k}") for k, t in enumerate(texts)], "k int, key string, v string").repartition(5)
    fits = lambda p, t: p is not None and t is not None and re.fullmatch(wildcard_regex(p)[5:], t.lower(), re.S | re.I) is not None
    hits = [[k for k, t in enumerate(texts) if fits(p if p is None else p.lower(), t)] for p in patterns]
    got = {r.i: r.v for r in wildcard_lookup(left, "p", right, "key", ["v"], "k", {"v": "none"}).collect()}
    assert got == {i: f"v{h[0]}" if h else "none" for i, h in enumerate(hits)}
    assert {r.i: r.position for r in wildcard_position(left, "p", right, "key", "k").collect()} == {i: h[0] + 1 if h else None for i, h in enumerate(hits)}
    assert {r.i: r.matches for r in wildcard_counts(left, "p", right, "key").collect()} == {i: len(h) for i, h in enumerate(hits)}


def test_no_pairs_without_a_shared_piece(spark):
    left = spark.range(2_000).select(F.concat(F.lit("*"), F.hex("id"), F.lit("zq*")).alias("p"))
    right = spark.range(2_000).select("id", F.concat(F.hex("id"), F.lit("zq")).alias("t"))
    out = wildcard_lookup(left, "p", right, "t", ["id"], "id")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert out.where("id is not null").count() == 2_000


def test_patterns_of_nothing(spark):
    left, right = spark.createDataFrame([("a*",)], "p string"), spark.createDataFrame([("ab", 1)], "t string, k int")
    assert [tuple(r) for r in wildcard_lookup(left, "p", right.limit(0), "t", ["k"], "k").collect()] == [("a*", None)]
    assert wildcard_lookup(left.limit(0), "p", right, "t", ["k"], "k").collect() == []
    assert [tuple(r) for r in wildcard_counts(left, "p", right.limit(0), "t").collect()] == [("a*", 0)]


CELLS = ["", None, "5", "=5", ">3", "<=2.5", "<>4", "apple", "=apple", "<>apple", "a*", "*p?e", ">b", "<b", ">=pear", "~*", "1e1", "zzz", "=", "<>"]


def test_criteria_tables_by_the_plain_criterion(spark):
    """Every row of a criteria table holds as the criteria strings of its cells do."""
    from gridloom.operators.criteria import block
    from gridloom.operators.criteria_tables import database_by_table, where_any

    rng = random.Random(9)
    values = ["apple", "Apple", "pear", "*", "", None, "5", "10", "ape", "b", "4.00000000001", "4"]
    rows = [(i, rng.choice(values), rng.choice([None, 5.0, 4.0, 2.5, -1.0, 10.0, float("nan")]), rng.choice(values)) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, word string, n double, other string")
    for trial in range(4):
        picked = [{"WORD": rng.choice(CELLS), "n": rng.choice(CELLS), "other": rng.choice(CELLS)} for _ in range(trial * 4 + 1)]
        picked = [p for p in picked if any(p.values())]
        criteria = spark.createDataFrame([(p["WORD"], p["n"], p["other"]) for p in picked], "WORD string, n string, other string")
        want = df.where(block([{k: v for k, v in (("word", p["WORD"]), ("n", p["n"]), ("other", p["other"])) if v} for p in picked]))
        assert sorted(r.id for r in where_any(df, criteria).collect()) == sorted(r.id for r in want.collect()), picked
    one = lambda *cells: spark.createDataFrame([cells], "word string, n string")
    assert where_any(df, one(None, "")).count() == 300 == where_any(df, one("a", "b").limit(0)).count()
    assert where_any(df, one("apple", None).withColumn("colour", F.lit("red"))).count() == 0
    assert where_any(df, one("apple", None).withColumn("colour", F.lit(""))).count() == sum(str(r[1]).lower() == "apple" for r in rows)
    big = spark.range(1_000).select(F.concat(F.lit("<"), F.col("id")).alias("n"), F.lit("p*").alias("word"))
    plan = where_any(df, big)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "LeftSemi" in plan
    got = database_by_table(df.where("n > 0"), ["DSUM", "DGET", "DCOUNT"], "n", one("apple", ">4")).first()
    some = [r[2] for r in rows if str(r[1]).lower() == "apple" and r[2] is not None and r[2] > 4]
    assert got.dsum == sum(some) and got.dcount == len(some) and got.dget == (some[0] if len(some) == 1 else None)


def test_of_criteria_rows_that_differ_in_a_bound_the_weakest_stays(spark):
    from gridloom.operators.criteria_tables import _cells, _weakest, where_any

    k = F.col("id")
    cell = lambda op, v: F.concat(F.lit(op), v.cast("string"))
    made = [
        (F.lit("a"), cell(">", 900 - k), None), (F.lit("p*"), cell("<=", -k), None), (None, cell(">=", 950 + k), cell("<", 5 + k)),
        (None, None, F.concat(F.lit("<"), F.lpad(k.cast("string"), 3, "0"), F.lit("z"))), (F.lit("b"), F.when(k % 2 == 0, cell("", k)).otherwise(F.concat(k.cast("string"), F.lit(".0"))), None),
    ]
    parts = [spark.range(300).select(*[(F.lit(None) if c is None else c).cast("string").alias(n) for c, n in zip(cells, ("word", "n", "m"))]) for cells in made]
    assert [_weakest(_cells(p, ["word", "n", "m"]), 3).count() for p in parts] == [1, 1, 300, 1, 300]
    assert _weakest(_cells(parts[2].select("n").union(parts[2].select("n")), ["n"]), 1).count() == 1
    df = spark.range(2000).select("id", F.element_at(F.array(*map(F.lit, ("a", "b", "pear"))), (k % 3 + 1).cast("int")).alias("word"), (k - 400).cast("double").alias("n"), F.when(k % 5 == 0, F.lit("298y")).when(k % 5 == 1, F.lit("3")).otherwise(F.lit("zz")).alias("m"))
    n, word = F.col("n"), F.col("word")
    pair = F.coalesce((n >= 950) & (F.col("m").try_cast("double") < n - 945 + 1e-9) & F.lit(True), F.lit(False))
    wants = [(word == "a") & (n > 601), (word == "pear") & (n <= 0), pair, F.col("m") == "298y", (word == "b") & n.between(0, 299)]
    for part, want in zip(parts, wants):
        assert {r.id for r in where_any(df, part).collect()} == {r.id for r in df.where(want).collect()}
