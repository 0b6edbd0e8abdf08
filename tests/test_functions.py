"""Functions against literal values, and the catalogue's completeness."""

import math

import pytest
from pyspark.sql import functions as F

from gridloom.functions import CATALOGUE, call
from gridloom.plans import registry

L = F.lit

#: (function, arguments, expected)
VALUES = [
    ("MOD", (-7, 3), 2.0), ("MOD", (7, -3), -2.0), ("MOD", (5, 0), None), ("ROUND", (2.5, 0), 3.0), ("ROUND", (-2.5, 0), -3.0), ("ROUND", (1234.5, -2), 1200.0),
    ("ROUNDUP", (-1.21, 1), -1.3), ("ROUNDDOWN", (-1.29, 1), -1.2), ("TRUNC", (-3.7,), -3.0), ("INT", (-3.2,), -4.0), ("CEILING", (4.2, 2), 6.0), ("CEILING", (4.2, -2), None),
    ("FLOOR", (-4.2, -2), -4.0), ("CEILING.MATH", (-5.5, 2), -4.0), ("CEILING.MATH", (-5.5, 2, 1), -6.0), ("FLOOR.MATH", (-5.5, 2), -6.0), ("FLOOR.MATH", (-5.5, 2, 1), -4.0),
    ("POWER", (0, 0), None), ("POWER", (-8, 1 / 3), -2.0), ("SQRT", (-1,), None), ("FACT", (25,), 1.5511210043330986e25), ("FACT", (171,), math.inf), ("FACTDOUBLE", (7,), 105.0),
    ("COMBIN", (8, 3), 56.0), ("COMBINA", (4, 3), 20.0), ("PERMUT", (5, 2), 20.0), ("MULTINOMIAL", (2, 3, 4), 1260.0), ("GCD", (24, 36, 60), 12.0), ("LCM", (4, 6, 10), 60.0),
    ("EVEN", (-1,), -2.0), ("ODD", (2,), 3.0), ("ODD", (0,), 1.0), ("MROUND", (10, 3), 9.0), ("MROUND", (-10, 3), None), ("QUOTIENT", (-10, 3), -3.0), ("ROMAN", (1994,), "MCMXCIV"),
    ("ARABIC", ("MCMXCIV",), 1994.0), ("ARABIC", ("-iv",), -4.0), ("BASE", (255, 16, 4), "00FF"), ("DECIMAL", ("zz", 36), 1295.0), ("ATAN2", (1, 2), math.atan2(2, 1)), ("ACOTH", (2,), 0.5 * math.log(3)),
    ("NORM.DIST", (42, 40, 1.5, True), 0.9087887802741321), ("NORM.S.INV", (0.908789,), 1.3333346730441074), ("GAMMA.DIST", (10.00001131, 9, 2, True), 0.06809400387),
    ("CHISQ.DIST.RT", (18.307, 10), 0.0500005892), ("CHISQ.INV", (0.93, 1), 3.2830202866), ("T.DIST.2T", (1.959999998, 60), 0.0546449297), ("T.INV", (0.75, 2), 0.8164965809), ("F.DIST.RT", (15.2068649, 6, 4), 0.01),
    ("F.INV", (0.01, 6, 4), 0.1093099084), ("BETA.DIST", (2, 8, 10, True, 1, 3), 0.6854705811), ("BETA.INV", (0.6854705811, 8, 10, 1, 3), 2.0), ("BINOM.DIST", (6, 10, 0.5, False), 0.205078125),
    ("BINOM.INV", (6, 0.5, 0.75), 4.0), ("NEGBINOM.DIST", (10, 5, 0.25, False), 0.0550486604), ("POISSON.DIST", (2, 5, True), 0.1246520195), ("HYPGEOM.DIST", (1, 4, 8, 20, False), 0.3632610939),
    ("WEIBULL.DIST", (105, 20, 100, True), 0.9295813901), ("LOGNORM.DIST", (4, 3.5, 1.2, True), 0.0390835557), ("LOGNORM.INV", (0.039084, 3.5, 1.2), 4.0000252), ("GAMMALN", (4,), math.log(6)), ("ERF", (0.745,), 0.7079289200957377),
    ("CONFIDENCE", (0.05, 2.5, 50), 0.6929519121), ("FISHER", (0.75,), 0.9729550745), ("GAUSS", (2,), 0.4772498680518208), ("PHI", (0.75,), 0.30113743215480443),
    ("PROPER", ("o'brien 2nd-ary",), "O'Brien 2Nd-Ary"), ("TRIM", ("  a   b ",), "a b"), ("LEN", ("abc",), 3), ("MID", ("abcdef", 2, 3), "bcd"), ("RIGHT", ("abc", 5), "abc"), ("REPT", ("ab", 3), "ababab"),
    ("FIND", ("c", "abcabc", 4), 6), ("FIND", ("z", "abc"), None), ("SEARCH", ("B?d", "abcd"), 2), ("SEARCH", ("~*", "a*b"), 2), ("SUBSTITUTE", ("a-b-c", "-", "+", 2), "a-b+c"), ("REPLACE", ("abcdef", 2, 3, "X"), "aXef"),
    ("TEXTBEFORE", ("a,b,c", ",", 2), "a,b"), ("TEXTBEFORE", ("abc", ","), None), ("TEXTAFTER", ("a,b,c", ",", -1), "c"), ("VALUE", ("$1,234.50",), 1234.5), ("VALUE", ("12%",), 0.12), ("VALUE", ("NaN",), None), ("VALUE", ("(5)",), -5.0),
    ("NUMBERVALUE", ("2.500,27", ",", "."), 2500.27), ("FIXED", (1234.567, 1), "1,234.6"), ("DOLLAR", (-1234.5,), "($1,234.50)"), ("UNICHAR", (8364,), "€"), ("UNICODE", ("€",), 8364), ("CLEAN", ("a\tb\x07",), "ab"),
    ("TEXT", (1234.5, "#,##0.00"), "1,234.50"), ("TEXT", (0.285, "0.0%"), "28.5%"), ("TEXT", (45000, "yyyy-mm-dd"), "2023-03-15"), ("TEXT", (0.5, "hh:mm"), "12:00"), ("TEXT", (5, "000"), "005"), ("TEXT", (-3, "0;(0)"), "(3)"),
    ("REGEXREPLACE", ("a1b2", "[0-9]", "#", 2), "a1b#"), ("LENB", ("a中",), 3), ("ASC", ("ＡＢ",), "AB"), ("EXACT", ("a", "A"), False),
    ("DATE", (2024, 14, 35), 45723.0), ("WEEKDAY", (45000,), 4), ("WEEKDAY", (45000, 2), 3), ("WEEKDAY", (45000, 3), 2), ("WEEKNUM", (45000,), 11), ("ISOWEEKNUM", (45656,), 1), ("EDATE", (45322, 1), 45351.0), ("EOMONTH", (45000, 1), 45046.0),
    ("DATEDIF", (44927, 45731, "Y"), 2.0), ("DATEDIF", (44927, 45731, "YM"), 2.0), ("DATEDIF", (44927, 45731, "M"), 26.0), ("NETWORKDAYS", (45000, 45014), 11), ("WORKDAY", (45000, 10), 45014.0), ("WORKDAY", (45000, -3), 44995.0), ("DAYS360", (45322, 45382), 60.0),
    ("YEARFRAC", (40909, 41120, 0), 0.5805555556), ("YEARFRAC", (40909, 41120, 1), 0.5765027322), ("YEARFRAC", (40909, 41120, 3), 0.5780821918), ("HOUR", (0.78125,), 18), ("MINUTE", (0.78125,), 45), ("TIME", (25, 0, 0), 1 / 24), ("DATEVALUE", ("2024-03-15",), 45366.0), ("TIMEVALUE", ("6:30 PM",), 0.7708333333),
    ("PMT", (0.08 / 12, 10, 10000), -1037.0320894), ("FV", (0.06 / 12, 10, -200, -500, 1), 2581.4033740601), ("PV", (0.08 / 12, 240, 500), -59777.1458512), ("NPER", (0.01, -100, -1000, 10000, 1), 59.6738656743), ("IPMT", (0.1 / 12, 1, 36, 8000), -66.6666666667),
    ("PPMT", (0.1 / 12, 1, 24, 2000), -75.6231860083), ("CUMIPMT", (0.09 / 12, 360, 125000, 13, 24, 0), -11135.2321307508), ("CUMPRINC", (0.09 / 12, 360, 125000, 13, 24, 0), -934.1071234208), ("RATE", (48, -200, 8000), 0.0077014725), ("SLN", (30000, 7500, 10), 2250.0), ("SYD", (30000, 7500, 10, 1), 4090.9090909),
    ("DB", (1000000, 100000, 6, 1, 7), 186083.3333333), ("DB", (1000000, 100000, 6, 7, 7), 15845.0984738), ("DDB", (2400, 300, 10, 10), 22.1225472), ("VDB", (2400, 300, 10, 0, 1), 480.0), ("VDB", (2400, 300, 10, 0, 0.875, 1.5), 315.0), ("EFFECT", (0.0525, 4), 0.0535426674), ("NOMINAL", (0.053543, 4), 0.0525003199),
    ("DOLLARDE", (1.02, 16), 1.125), ("DOLLARFR", (1.125, 16), 1.02), ("PDURATION", (0.025, 2000, 2200), 3.8598661626), ("RRI", (96, 10000, 11000), 0.0009933074), ("ISPMT", (0.1, 1, 3, 8000000), -533333.3333333),
    ("COUPNUM", (39107, 39767, 2), 4.0), ("COUPDAYBS", (40568, 40862, 2, 1), 71.0), ("COUPDAYS", (40568, 40862, 2, 1), 181.0), ("COUPDAYSNC", (40568, 40862, 2, 1), 110.0), ("COUPNCD", (40568, 40862, 2, 1), 40678.0), ("COUPPCD", (40568, 40862, 2, 1), 40497.0),
    ("PRICE", (39493, 43054, 0.0575, 0.065, 100, 2, 0), 94.6343616213), ("YIELD", (39493, 42689, 0.0575, 95.04287, 100, 2, 0), 0.0650000069), ("DURATION", (43282, 54058, 0.08, 0.09, 2, 1), 10.9191452816), ("MDURATION", (39448, 42370, 0.08, 0.09, 2, 1), 5.7356698139),
    ("TBILLPRICE", (39538, 39600, 0.09), 98.45), ("TBILLYIELD", (39538, 39600, 98.45), 0.0914169629), ("TBILLEQ", (39538, 39600, 0.0914), 0.094151494), ("DISC", (39107, 39248, 97.975, 100, 1), 0.0524202128), ("RECEIVED", (39493, 39583, 1000000, 0.0575, 2), 1014584.6544071),
    ("BIN2DEC", ("1111111111",), -1.0), ("DEC2BIN", (-1,), "1111111111"), ("DEC2HEX", (100, 4), "0064"), ("HEX2DEC", ("FFFFFFFF5B",), -165.0), ("OCT2HEX", ("100", 4), "0040"), ("BITLSHIFT", (4, 2), 16.0), ("BITRSHIFT", (13, 2), 3.0), ("BITAND", (-1, 2), None),
    ("CONVERT", (1, "lbm", "kg"), 0.45359237), ("CONVERT", (68, "F", "C"), 20.0), ("CONVERT", (2.5, "ft", "sec"), None), ("DELTA", (5, 4), 0), ("GESTEP", (5, 4), 1),
    ("COMPLEX", (3, -4), "3-4i"), ("COMPLEX", (0, 1), "i"), ("IMABS", ("5+12i",), 13.0), ("IMSUM", ("3+4i", "5-3i"), "8+i"), ("IMPRODUCT", ("3+4i", "5-3i"), "27+11i"), ("IMDIV", ("-238+240i", "10+24i"), "5+12i"), ("IMCONJUGATE", ("3+4i",), "3-4i"),
    ("IMPOWER", ("2+3i", 3), "-46+9i"), ("IMREAL", ("6-9i",), 6.0), ("IMAGINARY", ("0-j",), -1.0), ("IMREAL", ("x",), None), ("IMSQRT", ("-4",), "2i"),
    ("IFS", (False, 1, True, 2), 2), ("SWITCH", ("B", "a", 1, "b", 2, 0), 2), ("CHOOSE", (2, "a", "b"), "b"), ("CHOOSE", (5, "a", "b"), None), ("XOR", (True, True, True), True), ("NOT", (None,), True), ("IFERROR", (None, 7), 7), ("ERROR.TYPE", ("#N/A",), 7), ("ISNA", ("#N/A",), True),
    ("ADDRESS", (2, 3), "$C$2"), ("ADDRESS", (2, 703, 4), "AAA2"), ("ADDRESS", (2, 3, 1, False, "My Sheet"), "'My Sheet'!R2C3"),
]


@pytest.fixture(scope="module")
def one(spark):
    return spark.range(1)


def test_values(spark, one):
    """All in a few wide rows, so that the session plans few queries."""
    wrong = []
    for at in range(0, len(VALUES), 20):
        part = VALUES[at : at + 20]
        got = one.select(*[call(n, *[L(a) if isinstance(a, str) and n in ("VALUE", "TRIM", "LEN", "PROPER", "IMABS", "IMREAL", "IMAGINARY", "IMSQRT", "IMPOWER") and i == 0 else a for i, a in enumerate(args)]).alias(f"v{i}") for i, (n, args, _) in enumerate(part)]).first()
        for i, (n, args, want) in enumerate(part):
            have = got[i]
            good = have == want if not isinstance(want, float) or have is None else have == pytest.approx(want, rel=2e-7, abs=1e-9)
            if not good or (want is None) != (have is None):
                wrong.append((n, args, want, have))
    assert not wrong, wrong


def test_catalogue_is_complete():
    assert len(CATALOGUE) >= 461
    assert {"SUM", "VLOOKUP", "IRR", "LINEST", "MODE.SNGL", "SEQUENCE", "IMCSCH", "DVARP"} <= set(CATALOGUE)
    with pytest.raises(KeyError):
        call("NOSUCH", 1)


def test_array_functions(spark, one):
    a, m = F.array(*map(L, [3, 1, 2, 3])), F.array(F.array(L(1), L(2)), F.array(L(3), L(4)))
    got = one.select(
        call("SORT", a, True).alias("sort"), call("UNIQUE", a).alias("unique"), call("UNIQUE", a, True).alias("once"), call("TAKE", a, -2).alias("take"), call("DROP", a, 3).alias("drop"),
        call("TRANSPOSE", m).alias("t"), call("MMULT", m, m).alias("mm"), call("MDETERM", m).alias("det"), call("WRAPROWS", a, 3, 0).alias("wrap"), call("SCAN", 0, a, lambda s, x: s + x).alias("scan"),
        call("FILTER", a, lambda x: x > 5, -1).alias("none"), call("MAKEARRAY", 2, 2, lambda i, j: i * 10 + j).alias("made"), call("TEXTSPLIT", L("a,b;c"), ",", ";").alias("split"), call("EXPAND", a, 5, 9).alias("grown"),
        call("SORTBY", F.array(L("x"), L("y")), F.array(L(2), L(1))).alias("by"), call("SEQUENCE", 3, 5, 2).alias("seq"), call("INDEX", m, 2, 1).alias("at"), call("MINVERSE", m).alias("inv"),
    ).first().asDict()
    inverse = got.pop("inv")
    assert [round(x, 9) for r in inverse for x in r] == [-2.0, 1.0, 1.5, -0.5]
    assert got.pop("det") == pytest.approx(-2)
    assert got == {"sort": [3, 3, 2, 1], "unique": [3, 1, 2], "once": [1, 2], "take": [2, 3], "drop": [3], "t": [[1, 3], [2, 4]], "mm": [[7.0, 10.0], [15.0, 22.0]], "wrap": [[3, 1, 2], [3, 0, 0]], "scan": [3, 4, 6, 9], "none": [-1], "made": [[11, 12], [21, 22]], "split": [["a", "b"], ["c"]], "grown": [3, 1, 2, 3, 9], "by": ["y", "x"], "seq": [5, 7, 9], "at": 3}


def test_group_functions(spark):
    rows = [(i, float(v), "TRUE" if i == 1 else str(v)) for i, v in enumerate([3, 4, 5, 2, 3, 4, 5, 6, 4, 7])]
    df = spark.createDataFrame(rows, "i int, x double, s string")
    x = F.col("x")
    got = df.agg(call("SKEW", x).alias("skew"), call("KURT", x).alias("kurt"), call("LARGE", x, 2).alias("large"), call("PERCENTILE.EXC", x, 0.25).alias("exc"), call("COUNTIF", x, ">4").alias("n"), call("SUMIF", F.col("s"), "<>5", x).alias("s"), call("MAXA", F.col("s")).alias("maxa"), call("SUBTOTAL", 109, x, F.col("i") > 7).alias("sub"), call("AGGREGATE", 9, 6, x, None, F.when(F.col("i") == 0, "#N/A")).alias("agg"), call("DGET", "x", [{"i": 7}]).alias("dget")).first()
    assert got.skew == pytest.approx(0.359543071) and got.kurt == pytest.approx(-0.151799637)
    assert (got.large, got.exc, got.n, got.s, got.maxa, got["sub"], got["agg"], got.dget) == (6.0, 3.0, 4, 33.0, 7.0, 32.0, 40.0, 6.0)


def test_criteria_rules(spark):
    values = ["3", "abc", "ABC", "", None, "TRUE", "-1.5", "NaN", "1e999", "50%", "a*c", "2cm"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    count = lambda t: df.agg(call("COUNTIF", F.col("v"), t)).first()[0]
    assert [count(t) for t in ("abc", "=abc", "a?c", "a~*c", "=a*c", ">0", "<=3", "<>3", "", 3, "*")] == [2, 2, 3, 1, 1, 1, 2, 11, 12, 1, 12]


def test_cash_flow_rates(spark):
    from gridloom.functions.finance import irr

    flows = [("a", i, v) for i, v in enumerate([-70000.0, 12000.0, 15000.0, 18000.0, 21000.0, 26000.0])] + [("b", 0, 5.0), ("b", 1, 6.0)]
    got = {r.k: r.irr for r in irr(spark.createDataFrame(flows, "k string, t int, v double"), ["k"], "v", "t").collect()}
    assert got["a"] == pytest.approx(0.0866309480) and got["b"] is None
    days = [0, 60, 303, 411, 456]
    dated = spark.createDataFrame([(d / 365, v) for d, v in zip(days, [-10000.0, 2750.0, 4250.0, 3250.0, 2750.0])], "t double, v double")
    assert irr(dated, [], "v", "t").first().irr == pytest.approx(0.373362535, abs=1e-6)
    value, order = F.col("v"), F.col("t")
    mirr = spark.createDataFrame([(i, v) for i, v in enumerate([-120000.0, 39000.0, 30000.0, 21000.0, 37000.0, 46000.0])], "t int, v double").agg(call("MIRR", value, order, 0.1, 0.12, 6)).first()[0]
    assert mirr == pytest.approx(0.126094130)


def test_tests_of_hypotheses(spark):
    rows = [(3.0, 6.0), (4.0, 19.0), (5.0, 3.0), (8.0, 2.0), (9.0, 14.0), (1.0, 4.0), (2.0, 5.0), (4.0, 17.0), (5.0, 1.0)]
    df = spark.createDataFrame(rows, "x double, y double")
    stat, p = call("T.TEST", F.col("x"), F.col("y"), 2, 1)
    assert df.agg(stat.alias("s")).select(p(F.col("s"))).first()[0] == pytest.approx(0.196015785)
    stat, p = call("Z.TEST", F.col("x"), 4.0)
    assert 0 < df.agg(stat.alias("s")).select(p(F.col("s"))).first()[0] < 1


def test_fits(spark):
    from gridloom.functions.stats import linear_fit, predict

    df = spark.createDataFrame([(g, float(a), float(b), 2.0 * a - 3.0 * b + 5) for g in "xy" for a in range(5) for b in range(3)], "g string, a double, b double, y double")
    fit = linear_fit(df, ["g"], "y", ["a", "b"])
    for r in fit.collect():
        assert (r.a, r.b, r.intercept, r.r2) == pytest.approx((2, -3, 5, 1)) and r.df == 12
    assert predict(df, fit, ["g"], ["a", "b"]).where("abs(trend - y) > 1e-9").count() == 0
    grow = spark.createDataFrame([(float(i), 3.0 * 1.5**i) for i in range(6)], "t double, v double")
    r = linear_fit(grow, [], "v", ["t"], logs=True).first()
    assert (r.t, r.intercept) == pytest.approx((1.5, 3.0))


def test_datedif_over_month_ends(spark):
    """Years and months between all days around month ends, by the reference's borrowing rule."""
    import datetime as dt

    ends = [dt.date(y, m, d) for y in (2019, 2020, 2021) for m in (1, 2, 3, 4, 12) for d in (1, 27, 28, 29, 30, 31) if not (m == 2 and d > 28 + (y == 2020) or m == 4 and d == 31)]
    pairs = [((a - dt.date(1899, 12, 30)).days, (b - dt.date(1899, 12, 30)).days, a, b) for a in ends for b in ends if a <= b]
    rows = spark.createDataFrame(pairs, "a int, b int, x date, y date")
    got = rows.select("x", "y", call("DATEDIF", F.col("a"), F.col("b"), "Y").alias("years"), call("DATEDIF", F.col("a"), F.col("b"), "M").alias("months")).collect()
    for r in got:
        months = (r.y.year - r.x.year) * 12 + r.y.month - r.x.month - (r.y.day < r.x.day)
        assert (r.years, r.months) == (months // 12, months), (r.x, r.y)
    assert len(got) == len(pairs)


def test_n_by_kind(spark):
    row = spark.sql("SELECT 3.5D AS d, 7 AS i, true AS b, '12' AS s, 'x' AS w, CAST(NULL AS DOUBLE) AS z").select(*[call("N", F.col(x)).alias(x) for x in "dibswz"]).first()
    assert tuple(row) == (3.5, 7.0, 1.0, 0.0, 0.0, 0.0)


def test_kind_of_long_cells(spark):
    from gridloom.operators.profile import kind_of

    cells = ["9" * 400, "9" * 401, " " * 400 + "7", "x" * 500, "\t-1.5e3 ", ".5", "+", "2024-02-30", "2024-02-29", "1 2", "- 1"]
    got = spark.createDataFrame([(i, x) for i, x in enumerate(cells)], "i int, x string").orderBy("i").select(kind_of(F.col("x"))).collect()
    assert [r[0] for r in got] == ["number", "number", "number", "string", "number", "number", "string", "string", "date", "string", "string"]


def test_complex_texts_and_their_query_once_for_each_distinct_number(spark):
    texts = {"3-4i": (3.0, -4.0), " 1e+2 + j": (100.0, 1.0), "-i": (0.0, -1.0), "1e-2i": (0.0, 0.01), ".5": (0.5, 0.0), "2.+1e1j": (2.0, 10.0), "1-5": None, "1d": None, "": None, "3+": None, "1.2.3i": None, "NaN": None, "ii": None, "e5": None}
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", call("IMREAL", F.col("t")).alias("re"), call("IMAGINARY", F.col("t")).alias("im")).collect()
    assert {r.t: None if r.re is None and r.im is None else (r.re, r.im) for r in got} == texts
    assert registry.queries()["values_complex"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString().count("RepartitionByExpression") == 1


def test_order_statistics_of_the_aggregates_query_gather_no_group(spark):
    plan = registry.queries()["values_aggregates"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan
