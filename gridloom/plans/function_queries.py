"""Spreadsheet functions over the standard tables, one query a family."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.functions import call
from gridloom.functions.dates import serial
from gridloom.functions.order_stats import with_statistics
from gridloom.plans.registry import query
from gridloom.plans.tables import table


def _pick(df, key, exprs, digits=6):
    """Key and named expressions, doubles rounded."""
    out = df.select(*key, *[e.alias(n) for n, e in exprs.items()])
    return out.select(*[F.round(n, digits).alias(n) if t == "double" and n in exprs else F.col(n) for n, t in out.dtypes])


@query("""SELECT o_orderkey, round(trunc(x / 100) * 100, 6) AS down, round(ceil(abs(x) / 100) * 100, 6) AS up, round(ceil(x / 7) * 7, 6) AS ceiling, round(floor(x / 7) * 7, 6) AS floor,
  round(-x - -7 * floor(x / 7), 4) AS mod_below, round(-x - 7 * floor(-x / 7), 4) AS mod, trunc(x / 7) AS quotient,
  2 * ceil(x / 2) AS even, floor(x / 5 + 0.5) * 5 AS mround, round(sqrt(x), 6) AS sqrt, round(log10(x), 6) AS log10, round(ln(x), 6) AS ln, sign(-x) AS sign
FROM (SELECT o_orderkey, o_totalprice AS x FROM orders)""")
def math_rounding(spark, d):
    x = F.col("o_totalprice")
    return _pick(table(spark, d, "orders"), ["o_orderkey"], {
        "down": call("ROUNDDOWN", x, -2), "up": call("ROUNDUP", x, -2), "ceiling": call("CEILING", x, 7), "floor": call("FLOOR", x, 7), "mod_below": F.round(call("MOD", -x, -7), 4),
        "mod": F.round(call("MOD", -x, 7), 4), "quotient": call("QUOTIENT", x, 7), "even": call("EVEN", x), "mround": call("MROUND", x, 5), "sqrt": call("SQRT", x),
        "log10": call("LOG10", x), "ln": call("LN", x), "sign": call("SIGN", -x),
    })


@query("""SELECT l_orderkey, l_linenumber, round(sin(q), 6) AS sin, round(cos(q), 6) AS cos, round(tan(q), 6) AS tan, round(atan(q), 6) AS atan, round(atan2(q, 2.0), 6) AS atan2,
  round(sinh(q / 50), 6) AS sinh, round(1 / cosh(q / 50), 6) AS sech, round(pi() / 2 - atan(q), 6) AS acot, round(degrees(q), 6) AS degrees, round(1 / tan(q), 6) AS cot
FROM (SELECT *, l_quantity AS q FROM lineitem)""")
def math_trigonometry(spark, d):
    q = F.col("l_quantity")
    return _pick(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], {
        "sin": call("SIN", q), "cos": call("COS", q), "tan": call("TAN", q), "atan": call("ATAN", q), "atan2": call("ATAN2", 2.0, q), "sinh": call("SINH", q / 50),
        "sech": call("SECH", q / 50), "acot": call("ACOT", q), "degrees": call("DEGREES", q), "cot": call("COT", q),
    })


@query("""SELECT p_partkey, CAST(factorial(p_size % 15) AS DOUBLE) AS fact, CAST(gcd(p_partkey, 36) AS DOUBLE) AS gcd, CAST(lcm(p_size, 12) AS DOUBLE) AS lcm,
  upper(to_base(p_partkey, 16)) AS base16, CASE WHEN p_size >= 2 THEN CAST(p_size * (p_size - 1) / 2 AS DOUBLE) END AS combin, CASE WHEN p_size >= 2 THEN CAST(p_size * (p_size - 1) AS DOUBLE) END AS permut FROM part""")
def math_integers(spark, d):
    k, s = F.col("p_partkey"), F.col("p_size")
    return table(spark, d, "part").select("p_partkey", call("FACT", s % 15).alias("fact"), call("GCD", k, 36).alias("gcd"), call("LCM", s, 12).alias("lcm"), call("BASE", k, 16).alias("base16"), call("COMBIN", s, 2).alias("combin"), call("PERMUT", s, 2).alias("permut"))


@query("""SELECT l_returnflag, round(sum(l_tax), 4) AS sum, count(l_tax) AS count, round(sum(l_quantity * l_quantity), 2) AS sumsq, round(sum(l_quantity * l_discount), 4) AS sumproduct,
  round(median(l_extendedprice), 4) AS median, round(stddev_samp(l_extendedprice), 4) AS stdev, round(var_pop(l_quantity), 6) AS varp,
  round(quantile_cont(l_extendedprice, 0.9), 4) AS p90, round(skewness(l_quantity), 6) AS skew, round(kurtosis(l_quantity), 6) AS kurt, round(exp(avg(ln(l_quantity))), 6) AS geomean,
  round(count(*) / sum(1 / l_quantity), 6) AS harmean, round(var_pop(l_quantity) * count(*), 2) AS devsq FROM lineitem GROUP BY 1""")
def stats_descriptive(spark, d):
    q, x = F.col("l_quantity"), F.col("l_extendedprice")
    a = {"sum": (call("SUM", F.col("l_tax")), 4), "count": (call("COUNT", F.col("l_tax")), 0), "sumsq": (call("SUMSQ", q), 2), "sumproduct": (call("SUMPRODUCT", q, F.col("l_discount")), 4), "stdev": (call("STDEV.S", x), 4), "varp": (call("VAR.P", q), 6), "skew": (call("SKEW", q), 6), "kurt": (call("KURT", q), 6), "geomean": (call("GEOMEAN", q), 6), "harmean": (call("HARMEAN", q), 6), "devsq": (call("DEVSQ", q), 2)}
    want = {"median": ("median",), "p90": ("percentile", 0.9)}
    out = with_statistics(table(spark, d, "lineitem"), ["l_returnflag"], "l_extendedprice", want, [e.alias(n) for n, (e, _) in a.items()])
    digits = {n: k for n, (_, k) in a.items()} | {"median": 4, "p90": 4}
    return out.select("l_returnflag", *[F.round(n, k).alias(n) if k else F.col(n) for n, k in digits.items()])


@query("""SELECT l_linestatus, round(corr(l_extendedprice, l_quantity), 8) AS r, round(covar_pop(l_extendedprice, l_quantity), 4) AS cov, round(covar_samp(l_extendedprice, l_quantity), 4) AS covs,
  round(regr_slope(l_extendedprice, l_quantity), 6) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept, round(regr_r2(l_extendedprice, l_quantity), 8) AS rsq,
  round(sqrt((regr_syy(l_extendedprice, l_quantity) - regr_sxy(l_extendedprice, l_quantity) ** 2 / regr_sxx(l_extendedprice, l_quantity)) / (count(*) - 2)), 4) AS steyx,
  round(regr_intercept(l_extendedprice, l_quantity) + regr_slope(l_extendedprice, l_quantity) * 10, 4) AS forecast FROM lineitem GROUP BY 1""")
def stats_regression(spark, d):
    y, x = F.col("l_extendedprice"), F.col("l_quantity")
    a = {"r": (call("CORREL", y, x), 8), "cov": (call("COVARIANCE.P", y, x), 4), "covs": (call("COVARIANCE.S", y, x), 4), "slope": (call("SLOPE", y, x), 6), "intercept": (call("INTERCEPT", y, x), 4), "rsq": (call("RSQ", y, x), 8), "steyx": (call("STEYX", y, x), 4), "forecast": (call("FORECAST", 10, y, x), 4)}
    return table(spark, d, "lineitem").groupBy("l_linestatus").agg(*[F.round(e, k).alias(n) for n, (e, k) in a.items()])


@query("""SELECT l_returnflag, round(coalesce(sum(l_extendedprice) FILTER (WHERE l_quantity > 25 AND l_linestatus = 'O'), 0), 2) AS sumifs, count(*) FILTER (WHERE l_discount = 0.05) AS countif,
  round(avg(l_tax) FILTER (WHERE l_quantity <= 10), 8) AS averageif, max(l_quantity) FILTER (WHERE l_discount >= 0.07) AS maxifs, min(l_quantity) FILTER (WHERE l_tax <> 0) AS minifs,
  count(*) FILTER (WHERE l_linestatus LIKE 'o' OR l_linestatus LIKE 'O') AS wild FROM lineitem GROUP BY 1""")
def criteria_aggregates(spark, d):
    q = F.col("l_quantity")
    out = table(spark, d, "lineitem").groupBy("l_returnflag").agg(
        call("SUMIFS", F.col("l_extendedprice"), q, ">25", F.col("l_linestatus"), "=o").alias("sumifs"), call("COUNTIF", F.col("l_discount"), 0.05).alias("countif"),
        call("AVERAGEIF", q, "<=10", F.col("l_tax")).alias("averageif"), call("MAXIFS", q, F.col("l_discount"), ">=0.07").alias("maxifs"), call("MINIFS", q, F.col("l_tax"), "<>0").alias("minifs"),
        call("COUNTIF", F.col("l_linestatus"), "o*").alias("wild"),
    )
    return out.withColumn("sumifs", F.round("sumifs", 2)).withColumn("averageif", F.round("averageif", 8))


@query("""SELECT p_partkey, upper(p_name) AS upper, left(p_type, 5) AS "left", right(p_type, 4) AS "right", substr(p_type, 3, 6) AS mid, length(p_name) AS len,
  CASE WHEN instr(p_type, 'IUM') > 0 THEN instr(p_type, 'IUM') END AS find, p_brand || '/' || CAST(p_size AS VARCHAR) AS concat, repeat('ab', p_size % 4) AS rept,
  regexp_extract(p_brand, '[0-9]+') AS digits, replace(p_name, 'a', '_') AS substitute, split_part(p_type, ' ', 1) AS before, ascii(p_name) AS code, p_type = 'X' AS exact FROM part""")
def text_basic(spark, d):
    t, n = F.col("p_type"), F.col("p_name")
    return table(spark, d, "part").select(
        "p_partkey", call("UPPER", n).alias("upper"), call("LEFT", t, 5).alias("left"), call("RIGHT", t, 4).alias("right"), call("MID", t, 3, 6).alias("mid"), call("LEN", n).alias("len"),
        call("FIND", "IUM", t).alias("find"), call("TEXTJOIN", "/", False, F.col("p_brand"), F.col("p_size")).alias("concat"), call("REPT", "ab", F.col("p_size") % 4).alias("rept"),
        call("REGEXEXTRACT", F.col("p_brand"), "[0-9]+").alias("digits"), call("SUBSTITUTE", n, "a", "_").alias("substitute"),
        F.coalesce(call("TEXTBEFORE", t, " "), t).alias("before"), call("CODE", n).alias("code"), call("EXACT", t, "X").alias("exact"),
    )


@query("""SELECT o_orderkey, year(d) AS y, month(d) AS m, day(d) AS dd, isodow(d) AS wd, CAST(epoch(CAST(d AS TIMESTAMP)) / 86400 + 25569 AS DOUBLE) AS serial,
  CAST(epoch(CAST(CAST(last_day(d) AS DATE) AS TIMESTAMP)) / 86400 + 25569 AS DOUBLE) AS eomonth, CAST(epoch(CAST(CAST(d + INTERVAL 3 MONTH AS DATE) AS TIMESTAMP)) / 86400 + 25569 AS DOUBLE) AS edate,
  week(d) AS iso, len(list_filter(range(d, d + INTERVAL 29 DAY, INTERVAL 1 DAY), lambda x: isodow(x) < 6)) AS workdays, strftime(d, '%Y-%m-%d') AS text
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""")
def dates_basic(spark, d):
    s = serial(F.col("o_orderdate"))
    return table(spark, d, "orders").select(
        "o_orderkey", call("YEAR", s).alias("y"), call("MONTH", s).alias("m"), call("DAY", s).alias("dd"), call("WEEKDAY", s, 2).alias("wd"), s.alias("serial"),
        call("EOMONTH", s, 0).alias("eomonth"), call("EDATE", s, 3).alias("edate"), call("ISOWEEKNUM", s).alias("iso"), call("NETWORKDAYS", s, s + 28).alias("workdays"), call("TEXT", s, "yyyy-mm-dd").alias("text"),
    )


@query("""SELECT l_orderkey, l_linenumber, round(-(p * r * power(1 + r, n)) / (power(1 + r, n) - 1), 3) AS pmt, round(p * power(1 + r, n), 2) AS fv, round(p / power(1 + r, n), 3) AS pv,
  round((p - 100) / n, 6) AS sln, round((p - 100) * n * 2 / (n * (n + 1)), 6) AS syd, round(power(1 + r / 12, 12) - 1, 8) AS effect, round(p * r * 30 / 360, 6) AS accrued
FROM (SELECT *, l_extendedprice AS p, l_tax + 0.01 AS r, 12 + l_linenumber AS n FROM lineitem)""")
def finance_annuities(spark, d):
    p, r, n = F.col("l_extendedprice"), F.col("l_tax") + 0.01, F.lit(12) + F.col("l_linenumber")
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.round(call("PMT", r, n, p), 3).alias("pmt"), F.round(call("FV", r, n, 0, -p), 2).alias("fv"), F.round(call("PV", r, n, 0, -p), 3).alias("pv"),
        F.round(call("SLN", p, 100, n), 6).alias("sln"), F.round(call("SYD", p, 100, n, 1), 6).alias("syd"), F.round(call("EFFECT", r, 12), 8).alias("effect"),
        F.round(call("ACCRINTM", 40000, 40030, r, p, 2), 6).alias("accrued"),
    )


@query("""SELECT l_orderkey, round(sum(l_extendedprice / power(1.05, l_linenumber)), 4) AS npv, round(product(1 + l_tax), 8) AS grown FROM lineitem GROUP BY 1""")
def finance_cash_flows(spark, d):
    out = table(spark, d, "lineitem").groupBy("l_orderkey").agg(call("NPV", 0.05, F.col("l_extendedprice"), F.col("l_linenumber")).alias("npv"), call("FVSCHEDULE", 1, F.col("l_tax")).alias("grown"))
    return out.select("l_orderkey", F.round("npv", 4).alias("npv"), F.round("grown", 8).alias("grown"))


@query("""SELECT c_custkey, upper(to_base(c_custkey % 500, 2)) AS bin, upper(to_base(c_custkey, 16)) AS hex, CAST(c_custkey & 12 AS DOUBLE) AS bitand, CAST(xor(c_custkey, 5) AS DOUBLE) AS bitxor, CAST(c_custkey << 3 AS DOUBLE) AS shifted,
  round(c_acctbal * 1609.344, 4) AS metres, round((c_acctbal - 32) * 5 / 9, 6) AS celsius, CAST(c_custkey >= 100 AS INT) AS step FROM customer""")
def engineering_numbers(spark, d):
    k, x = F.col("c_custkey"), F.col("c_acctbal")
    return table(spark, d, "customer").select(
        "c_custkey", call("DEC2BIN", k % 500).alias("bin"), call("DEC2HEX", k).alias("hex"), call("BITAND", k, 12).alias("bitand"), call("BITXOR", k, 5).alias("bitxor"), call("BITLSHIFT", k, 3).alias("shifted"),
        F.round(call("CONVERT", x, "mi", "m"), 4).alias("metres"), F.round(call("CONVERT", x, "F", "C"), 6).alias("celsius"), call("GESTEP", k, 100).alias("step"),
    )


@query("""SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) || '+' || CAST(l_linenumber + 1 AS BIGINT) || 'i' AS z, round(sqrt(l_quantity ** 2 + (l_linenumber + 1) ** 2), 8) AS size,
  CAST(l_quantity * 2 - (l_linenumber + 1) * 3 AS BIGINT) AS re FROM lineitem""")
def engineering_complex(spark, d):
    z = call("COMPLEX", F.col("l_quantity"), F.col("l_linenumber") + 1)
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", z.alias("z"), F.round(call("IMABS", z), 8).alias("size"), call("IMREAL", call("IMPRODUCT", z, "2+3i")).cast("bigint").alias("re"))


@query("""SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'low' WHEN c_acctbal < 5000 THEN 'mid' ELSE 'high' END AS ifs, CASE lower(c_mktsegment) WHEN 'building' THEN 1 WHEN 'machinery' THEN 2 ELSE 0 END AS switch,
  (c_custkey % 2 = 0) <> (c_acctbal > 0) AS xor, ['a', 'b', 'c'][c_custkey % 3 + 1] AS choose, c_custkey % 2 = 0 AS even FROM customer""")
def logic_branches(spark, d):
    x, k = F.col("c_acctbal"), F.col("c_custkey")
    return table(spark, d, "customer").select(
        "c_custkey", call("IFS", x < 0, "low", x < 5000, "mid", True, "high").alias("ifs"), call("SWITCH", F.col("c_mktsegment"), "Building", 1, "Machinery", 2, 0).alias("switch"),
        call("XOR", k % 2 == 0, x > 0).alias("xor"), call("CHOOSE", k % 3 + 1, "a", "b", "c").alias("choose"), call("ISEVEN", k).alias("even"),
    )


@query("""SELECT user_id, array_to_string(list_sort(list(event_id))[:3], ',') AS take, len(list(event_id)) AS rows, array_to_string(list_reverse_sort(list_distinct(list(event_type))), ',') AS kinds, CAST(list_sum(list(event_id)) AS BIGINT) AS total FROM events GROUP BY 1""")
def array_values(spark, d):
    ids = call("SORT", F.collect_list("event_id"))
    out = table(spark, d, "events").groupBy("user_id").agg(ids.alias("a"), F.collect_list("event_type").alias("k"))
    return out.select("user_id", F.array_join(call("TAKE", F.col("a"), 3).cast("array<string>"), ",").alias("take"), call("ROWS", F.col("a")).alias("rows"), F.array_join(call("SORT", call("UNIQUE", F.col("k")), True), ",").alias("kinds"), call("REDUCE", F.lit(0).cast("bigint"), F.col("a"), lambda s, x: s + x).alias("total"))
