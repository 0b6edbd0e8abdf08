"""Folds over a total order in stretches, against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from gridloom.functions.ordered import Fold, cut_points, scan


def brute(rows, order, by):
    """rows: dicts. Adds the folds of ``value`` in order."""

    def key(r):
        out = []
        for o in [*by, *order]:
            name, down = o.lstrip("-"), o.startswith("-")
            v = r[name]
            out.append((v is not None, Up(v, down)))
            if down:
                out[-1] = (v is None, Up(v, down))
        return out

    state, result = {}, {}
    for r in sorted(rows, key=key):
        s = state.setdefault(tuple(r[b] for b in by), [])
        v, seen = r["value"], [x for x in s if x is not None]
        s.append(v)
        now = [x for x in s if x is not None]
        result[r["id"]] = (sum(now) if now else None, len(seen), min(now, default=None), max(seen, default=None), now[0] if now else None, seen[-1] if seen else None)
    return result


class Up:
    def __init__(self, v, down):
        self.v, self.down = v, down

    def __lt__(self, other):
        if self.v is None or other.v is None:
            return False
        return self.v > other.v if self.down else self.v < other.v

    def __eq__(self, other):
        return self.v == other.v


@pytest.mark.parametrize("order", [["at", "id"], ["-at", "-id"], ["-word", "id"], ["word", "-id"]])
@pytest.mark.parametrize("by", [[], ["k"], ["k", "j"]])
def test_scan(spark, order, by):
    rng = random.Random(len(order[0]) + len(by))
    rows = [{"id": i, "at": rng.choice([None, float("nan") if False else 1.5, 2.5, rng.random() * 9]), "word": rng.choice([None, "a", "b", "zz"]), "k": rng.choice([None, "hot", "hot", "hot", "x"]), "j": rng.choice([0, 1]), "value": rng.choice([None, rng.randint(-50, 50)])} for i in range(400)]
    df = spark.createDataFrame(rows, "id int, at double, word string, k string, j int, value int")
    v = F.col("value")
    folds = {"s": Fold("sum", v), "n": Fold("count", v, True), "lo": Fold("min", v), "hi": Fold("max", v, True), "f": Fold("first", v), "l": Fold("last", v, True)}
    got = scan(df, order, folds, by, pieces=9)
    assert got.columns == [*df.columns, *folds]
    assert {r.id: (r.s, r.n or 0, r.lo, r.hi, r.f, r.l) for r in got.collect()} == brute(rows, order, by)


def test_stretches_are_about_equal_and_cuts_bounded(spark):
    df = spark.range(20_000).withColumn("x", F.hash("id"))
    cuts = cut_points(df, ["x"], 10)
    assert len(cuts) == 9 and cuts == sorted(cuts)
    counts = scan(df, ["x"], {"n": Fold("count", F.col("id"))}, pieces=10)
    assert counts.agg(F.max("n")).first()[0] == 20_000 and counts.select("n").distinct().count() == 20_000
    # one task sees the stretches' sums only
    assert counts._jdf.queryExecution().executedPlan().toString().count("Exchange SinglePartition") == 1
    empty = scan(df.limit(0), ["x"], {"n": Fold("count", F.col("id"))})
    assert empty.collect() == []


@pytest.mark.parametrize("few", [10**6, 40])
def test_order_statistics(spark, few):
    """Against sorted lists; with a low limit over several rounds of finer intervals."""
    import math

    from gridloom.functions.order_stats import order_statistics, with_statistics

    rng = random.Random(few)
    rows = [(rng.choice(["hot", "hot", "hot", "x", None]), rng.choice([None, 1e300, -5.0, 7.0, float(rng.randint(0, 9)), rng.gauss(0, 1), rng.random() * 1e-9])) for _ in range(3000)]
    rows += [("one", 3.5), ("none", None), ("two", 1.0), ("two", 2.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    want = {"m": ("median",), "p": ("percentile", 0.93), "pe": ("percentile_exc", 0.01), "q": ("quartile", 3), "qe": ("quartile_exc", 1), "l": ("large", 2), "s": ("small", 40), "top": ("large", 1)}

    def brute(values):
        values, n = sorted(values), len(values)
        places = {"m": (n - 1) / 2, "p": (n - 1) * 0.93, "pe": 0.01 * (n + 1) - 1, "q": (n - 1) * 0.75, "qe": 0.25 * (n + 1) - 1, "l": n - 2, "s": 39, "top": n - 1}
        out = {}
        for name, at in places.items():
            low, high = math.floor(at), math.ceil(at)
            out[name] = None if at < 0 or at > n - 1 else values[low] if values[low] == values[high] else values[low] * (1 - (at - low)) + values[high] * (at - low)
        return out

    groups = {}
    for k, v in rows:
        groups.setdefault(k, []).append(v)
    got = {r.k: r for r in order_statistics(df, ["k"], "v", want, few).collect()}
    assert set(got) == set(groups) - {"none"}
    for k, r in got.items():
        own = [v for v in groups[k] if v is not None]
        assert r.n == len(own)
        for name, v in brute(own).items():
            assert (r[name] is None) == (v is None) and (v is None or math.isclose(r[name], v, rel_tol=1e-12, abs_tol=1e-300)), (k, name)
    whole = order_statistics(df, [], "v", {"m": ("median",)}, few).first()
    assert math.isclose(whole.m, brute([v for _, v in rows if v is not None])["m"])
    both = {r.k: (r.rows, r.m) for r in with_statistics(df, ["k"], "v", {"m": ("median",)}, [F.count("*").alias("rows")]).collect()}
    assert both["none"] == (1, None) and both["two"] == (2, 1.5)
    assert order_statistics(df.limit(0), ["k"], "v", want).collect() == []


def test_a_value_that_nearly_all_rows_have(spark):
    from gridloom.functions.order_stats import order_statistics

    df = spark.range(20_000).select(F.when(F.col("id") < 19_990, 0.0).otherwise(F.col("id").cast("double")).alias("v"))
    got = order_statistics(df, [], "v", {"m": ("median",), "low": ("small", 1), "edge": ("small", 19_991), "top": ("large", 1)}, few=5).first()
    assert (got.m, got.low, got.edge, got.top) == (0.0, 0.0, 19_990.0, 19_999.0)
