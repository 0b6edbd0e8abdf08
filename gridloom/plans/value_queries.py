"""Function by function over whole tables: every column is one call, beside the same value written in SQL.

A column is (alias, Column as a lambda, SQL). Numbers become doubles of six decimals on both sides; an
alias that starts with ``t_`` is text and one with ``b_`` is a truth value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridloom.functions import call as C
from gridloom.functions.dates import serial
from gridloom.functions.order_stats import null_safe_join, order_statistics
from gridloom.plans.registry import query
from gridloom.plans.tables import table

def _columns(name: str, source: str, keys: list[str], named: dict[str, str], columns: list[tuple[str, Callable[[], Column], str]], group: bool = False, digits: int = 6, steps: list[dict[str, Callable[[], Column]]] = (), ordered: list[tuple[Callable[[], Column], dict[str, tuple]]] = ()):
    """Register a query over the table ``source`` whose ``named`` SQL expressions are columns first.

    ``steps`` are columns made of these that others are computed from. As they are costly, all is computed once for each
    distinct row of ``named``, dealt out over all tasks, and joined back. ``ordered`` are values and the order statistics of
    each group that are taken of them without gathering the group, in place of the columns of their names.
    """

    def shown(alias: str, sql: str) -> str:
        return f"{sql} AS {alias}" if alias[:2] in ("t_", "b_") else f"round(CAST({sql} AS DOUBLE), {digits}) AS {alias}"

    inner = ", ".join(f"{e} AS {n}" for n, e in named.items())
    sql = f"SELECT {', '.join([*keys, *[shown(a, s) for a, _, s in columns]])} FROM (SELECT *, {inner} FROM {source})" + (f" GROUP BY {', '.join(keys)}" if group else "")

    def run(spark, d):
        df = table(spark, d, source).selectExpr("*", *[f"{e} AS {n}" for n, e in named.items()])
        if steps:
            rows = df.select(*keys, *named)
            df = rows.select(*named).distinct().repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *named)
        for step in steps:
            df = df.withColumns({n: f() for n, f in step.items()})
        placed = {a for _, want in ordered for a in want}
        own = [(a, f()) for a, f, _ in columns if a not in placed]
        if steps:
            df = null_safe_join(rows, df.select(*named, *[c.alias(a) for a, c in own]), list(named))
            own = [(a, F.col(a)) for a, _ in own]
        out = df.groupBy(*keys).agg(*[c.alias(a) for a, c in own]) if group else df.select(*keys, *[c.alias(a) for a, c in own])
        for value, want in ordered:
            out = null_safe_join(out, order_statistics(df.withColumn("__value", value()), keys, "__value", want).drop("n"), keys, "left")
        plain = lambda a: F.col(a) if a[:2] in ("t_", "b_") else F.round(F.col(a).cast("double"), digits).alias(a)
        return out.select(*keys, *[plain(a) for a, _, _ in columns])

    run.__name__ = run.__qualname__ = name
    query(sql)(run)


def v(name: str) -> Column:
    return F.col(name)


#: Sizes, keys and prices of parts, and a small number of either sign.
_PART = {"s": "p_size", "k": "p_partkey", "r": "p_retailprice", "x": "CAST((p_size - 25) / 10.0 AS DOUBLE)", "u": "p_size / CAST(60 AS DOUBLE)"}

_columns("values_math", "part", ["p_partkey"], _PART, [
    ("f_abs", lambda: C("ABS", v("x")), "abs(x)"),
    ("f_int", lambda: C("INT", v("x")), "floor(x)"),
    ("f_round", lambda: C("ROUND", v("x") * 7, 0), "CASE WHEN x < 0 THEN -floor(abs(x * 7) + 0.5) ELSE floor(x * 7 + 0.5) END"),
    ("f_ceiling_math", lambda: C("CEILING.MATH", v("x"), 0.5), "ceil(x / 0.5) * 0.5"),
    ("f_ceiling_away", lambda: C("CEILING.MATH", v("x"), 1, 1), "CASE WHEN x < 0 THEN floor(x) ELSE ceil(x) END"),
    ("f_floor_math", lambda: C("FLOOR.MATH", v("x"), 0.5), "floor(x / 0.5) * 0.5"),
    ("f_floor_toward", lambda: C("FLOOR.MATH", v("x"), 1, 1), "CASE WHEN x < 0 THEN ceil(x) ELSE floor(x) END"),
    ("f_ceiling_precise", lambda: C("CEILING.PRECISE", v("x"), -0.5), "ceil(x / 0.5) * 0.5"),
    ("f_iso_ceiling", lambda: C("ISO.CEILING", v("x"), 2), "ceil(x / 2) * 2"),
    ("f_floor_precise", lambda: C("FLOOR.PRECISE", v("x"), -0.5), "floor(x / 0.5) * 0.5"),
    ("f_trunc", lambda: C("TRUNC", v("x")), "trunc(x)"),
    ("f_power", lambda: C("POWER", v("s"), 0.5), "sqrt(s)"),
    ("f_power_root", lambda: C("POWER", v("x"), 1 / 3), "CASE WHEN x <> 0 THEN sign(x) * pow(abs(x), 1.0 / 3) ELSE 0 END"),
    ("f_combina", lambda: C("COMBINA", v("s"), 2), "s * (s + 1) / 2"),
    ("f_permutationa", lambda: C("PERMUTATIONA", v("s"), 3), "s * s * s"),
    ("f_sqrtpi", lambda: C("SQRTPI", v("s")), "sqrt(s * pi())"),
    ("f_factdouble", lambda: C("FACTDOUBLE", v("s") % 12), "coalesce(list_product([CAST(i AS DOUBLE) FOR i IN range(s % 12, 0, -2)]), 1)"),
    ("f_multinomial", lambda: C("MULTINOMIAL", v("s") % 5, 2, 3), "factorial(s % 5 + 5) / (factorial(s % 5) * 12.0)"),
    ("f_seriessum", lambda: C("SERIESSUM", v("x"), 1, 2, F.array(F.lit(1.0), F.lit(0.5), F.lit(0.25))), "x + 0.5 * x ** 3 + 0.25 * x ** 5"),
    ("f_odd", lambda: C("ODD", v("x") * 3), "CASE WHEN x = 0 THEN 1 ELSE sign(x) * greatest(ceil((abs(x * 3) - 1) / 2) * 2 + 1, 1) END"),
    ("t_roman", lambda: C("ROMAN", v("s")), "(['', 'X', 'XX', 'XXX', 'XL', 'L'])[s // 10 + 1] || (['', 'I', 'II', 'III', 'IV', 'V', 'VI', 'VII', 'VIII', 'IX'])[s % 10 + 1]"),
    ("f_arabic", lambda: C("ARABIC", C("ROMAN", v("k") % 4000)), "k % 4000"),
    ("f_decimal", lambda: C("DECIMAL", C("BASE", v("k"), 7), 7), "k"),
    ("f_log", lambda: C("LOG", v("s"), 2), "log2(s)"),
    ("f_exp", lambda: C("EXP", v("x")), "exp(x)"),
    ("f_pi", lambda: C("PI"), "pi()"),
    ("f_asin", lambda: C("ASIN", v("x") / 3), "asin(x / 3)"),
    ("f_acos", lambda: C("ACOS", v("x") / 3), "acos(x / 3)"),
    ("f_cosh", lambda: C("COSH", v("x")), "cosh(x)"),
    ("f_tanh", lambda: C("TANH", v("x")), "tanh(x)"),
    ("f_asinh", lambda: C("ASINH", v("x")), "ln(x + sqrt(x * x + 1))"),
    ("f_acosh", lambda: C("ACOSH", v("s")), "ln(s + sqrt(s * s - 1))"),
    ("f_atanh", lambda: C("ATANH", v("x") / 3), "ln((3 + x) / (3 - x)) / 2"),
    ("f_radians", lambda: C("RADIANS", v("s")), "s * pi() / 180"),
    ("f_sec", lambda: C("SEC", v("x")), "1 / cos(x)"),
    ("f_csc", lambda: C("CSC", v("s")), "1 / sin(s)"),
    ("f_csch", lambda: C("CSCH", v("s") / 10), "1 / sinh(s / 10.0)"),
    ("f_coth", lambda: C("COTH", v("s") / 10), "1 / tanh(s / 10.0)"),
    ("f_acoth", lambda: C("ACOTH", v("s") + 1), "ln((s + 2) / CAST(s AS DOUBLE)) / 2"),
    ("f_fisher", lambda: C("FISHER", v("x") / 3), "ln((3 + x) / (3 - x)) / 2"),
    ("f_fisherinv", lambda: C("FISHERINV", v("x")), "tanh(x)"),
    ("f_standardize", lambda: C("STANDARDIZE", v("r"), 900, 30), "(r - 900) / 30"),
    ("b_rand", lambda: (C("RAND") >= 0) & (C("RAND") < 1), "true"),
    ("b_randbetween", lambda: C("RANDBETWEEN", 3, v("s") + 3).between(3, v("s") + 3), "true"),
    ("f_delta", lambda: C("DELTA", v("s"), 25), "CAST(s = 25 AS INTEGER)"),
    ("f_bitor", lambda: C("BITOR", v("k"), 12), "k | 12"),
    ("f_bitrshift", lambda: C("BITRSHIFT", v("k"), 2), "k >> 2"),
])

_EXC = "(CASE WHEN {p} * (count({c}) + 1) >= 1 AND {p} * (count({c}) + 1) <= count({c}) THEN list_sort(list({c}))[CAST(floor({p} * (count({c}) + 1)) AS BIGINT)] + ({p} * (count({c}) + 1) - floor({p} * (count({c}) + 1))) * (list_sort(list({c}))[CAST(ceil({p} * (count({c}) + 1)) AS BIGINT)] - list_sort(list({c}))[CAST(floor({p} * (count({c}) + 1)) AS BIGINT)]) END)"

_columns("values_aggregates", "lineitem", ["l_returnflag"], {"q": "l_quantity", "w": "l_extendedprice / 1000", "hid": "l_linestatus = 'F'", "err": "CASE WHEN l_linenumber = 3 THEN '#N/A' END", "mixed": "CASE WHEN l_tax > 0.05 THEN CAST(l_linenumber AS VARCHAR(9)) WHEN l_tax > 0 THEN 'TRUE' ELSE 'none' END"}, [
    ("f_average", lambda: C("AVERAGE", v("q")), "avg(q)"),
    ("f_counta", lambda: C("COUNTA", v("err")), "count(err)"),
    ("f_sumx2py2", lambda: C("SUMX2PY2", v("q"), v("l_tax")), "sum(q * q + l_tax * l_tax)"),
    ("f_product", lambda: C("PRODUCT", 1 + v("l_tax") / 10000), "exp(sum(ln(1 + l_tax / 10000)))"),
    ("f_stdevp", lambda: C("STDEVP", v("q")), "stddev_pop(q)"),
    ("f_stdev_p", lambda: C("STDEV.P", v("w")), "stddev_pop(w)"),
    ("f_var", lambda: C("VAR", v("q")), "var_samp(q)"),
    ("f_var_s", lambda: C("VAR.S", v("w")), "var_samp(w)"),
    ("f_averagea", lambda: C("AVERAGEA", v("mixed")), "avg(CASE WHEN l_tax > 0.05 THEN l_linenumber WHEN l_tax > 0 THEN 1 ELSE 0 END)"),
    ("f_maxa", lambda: C("MAXA", v("mixed")), "max(CASE WHEN l_tax > 0.05 THEN l_linenumber WHEN l_tax > 0 THEN 1 ELSE 0 END)"),
    ("f_mina", lambda: C("MINA", v("mixed")), "min(CASE WHEN l_tax > 0.05 THEN l_linenumber WHEN l_tax > 0 THEN 1 ELSE 0 END)"),
    ("f_percentile_exc", None, _EXC.format(p=0.37, c="w")),
    ("f_quartile_exc", None, _EXC.format(p=0.75, c="w")),
    ("f_large", None, "list_sort(list(w), 'DESC')[7]"),
    ("f_small", None, "list_sort(list(w))[7]"),
    ("f_subtotal", lambda: C("SUBTOTAL", 9, v("q"), v("hid")), "sum(q)"),
    ("f_subtotal_shown", lambda: C("SUBTOTAL", 101, v("q"), v("hid")), "avg(q) FILTER (WHERE NOT hid)"),
    ("f_aggregate", None, "list_sort(list(q + l_tax) FILTER (WHERE err IS NULL), 'DESC')[2]"),
    ("f_aggregate_error", lambda: C("AGGREGATE", 9, 4, v("q"), None, v("err")), "CAST(NULL AS DOUBLE)"),
    ("f_sumif", lambda: C("SUMIF", v("l_linenumber"), ">=4", v("q")), "sum(q) FILTER (WHERE l_linenumber >= 4)"),
    ("f_countifs", lambda: C("COUNTIFS", v("q"), "<10", v("l_linestatus"), "O"), "count(*) FILTER (WHERE q < 10 AND l_linestatus = 'O')"),
    ("f_averageifs", lambda: C("AVERAGEIFS", v("w"), v("q"), "<>7", v("l_tax"), "<=0.04"), "avg(w) FILTER (WHERE q <> 7 AND l_tax <= 0.04)"),
    ("f_dcounta", lambda: C("DCOUNTA", "l_linestatus", [{"q": ">45"}, {"l_tax": "=0"}]), "count(*) FILTER (WHERE q > 45 OR l_tax = 0)"),
    ("f_dproduct", lambda: C("DPRODUCT", "w", [{"q": "1", "l_tax": "0", "l_discount": "0", "l_linenumber": "1"}]), "coalesce(product(w) FILTER (WHERE q = 1 AND l_tax = 0 AND l_discount = 0 AND l_linenumber = 1), 1)"),
    ("f_dget_many", lambda: C("DGET", "w", [{"q": ">45"}]), "CAST(NULL AS DOUBLE)"),
    ("f_dstdevp", lambda: C("DSTDEVP", "w", [{"q": ">45"}]), "stddev_pop(w) FILTER (WHERE q > 45)"),
    ("f_dvar", lambda: C("DVAR", "w", [{"q": ">45", "l_tax": ">0.02"}]), "var_samp(w) FILTER (WHERE q > 45 AND l_tax > 0.02)"),
], group=True, digits=4, ordered=[
    (lambda: v("w"), {"f_percentile_exc": ("percentile_exc", 0.37), "f_quartile_exc": ("quartile_exc", 3), "f_large": ("large", 7), "f_small": ("small", 7)}),
    (lambda: F.when(v("err").isNull(), v("q") + v("l_tax")), {"f_aggregate": ("large", 2)}),
])

_columns("values_logic", "customer", ["c_custkey"], {"bal": "c_acctbal", "seg": "c_mktsegment", "err": "CASE WHEN c_nationkey = 3 THEN '#N/A' WHEN c_nationkey = 4 THEN '#REF!' END", "gap": "CASE WHEN c_nationkey NOT IN (3, 4) THEN c_acctbal END"}, [
    ("t_if", lambda: C("IF", v("bal") > 0, "credit", "debt"), "CASE WHEN bal > 0 THEN 'credit' ELSE 'debt' END"),
    ("b_and", lambda: C("AND", v("bal") > 0, v("c_nationkey") > 9), "bal > 0 AND c_nationkey > 9"),
    ("b_or", lambda: C("OR", v("bal") > 5000, v("gap") < 0), "bal > 5000 OR coalesce(gap < 0, false)"),
    ("b_not", lambda: C("NOT", v("bal") > 0), "NOT bal > 0"),
    ("b_true", lambda: C("TRUE"), "true"),
    ("b_false", lambda: C("FALSE"), "false"),
    ("f_iferror", lambda: C("IFERROR", v("gap"), -1.0), "coalesce(gap, -1)"),
    ("f_ifna", lambda: C("IFNA", v("gap"), -2.0, v("err")), "CASE WHEN c_nationkey = 3 THEN -2 ELSE gap END"),
    ("b_isomitted", lambda: C("ISOMITTED"), "true"),
    ("b_isnumber", lambda: C("ISNUMBER", v("gap")), "gap IS NOT NULL"),
    ("b_istext", lambda: C("ISTEXT", v("seg")), "true"),
    ("b_isnontext", lambda: C("ISNONTEXT", v("gap"), "double"), "true"),
    ("b_islogical", lambda: C("ISLOGICAL", v("bal") > 0), "true"),
    ("b_isblank", lambda: C("ISBLANK", v("gap")), "gap IS NULL"),
    ("b_iserr", lambda: C("ISERR", v("err")), "coalesce(err = '#REF!', false)"),
    ("b_isodd", lambda: C("ISODD", v("bal")), "CAST(floor(abs(bal)) AS BIGINT) % 2 = 1"),
    ("b_isref", lambda: C("ISREF", v("bal")), "true"),
    ("b_isformula", lambda: C("ISFORMULA", v("err")), "err IS NOT NULL"),
    ("f_type", lambda: C("TYPE", v("gap"), "double", v("err")), "CASE WHEN err IS NULL THEN 1 ELSE 16 END"),
    ("f_type_text", lambda: C("TYPE", v("seg"), "string"), "2"),
    ("t_na", lambda: C("NA"), "'#N/A'"),
])

_columns("values_text", "customer", ["c_custkey"], {"name": "c_name", "seg": "c_mktsegment", "bal": "c_acctbal", "key": "c_custkey"}, [
    ("t_concat", lambda: C("CONCAT", v("seg"), "-", v("key")), "seg || '-' || key"),
    ("t_concatenate", lambda: C("CONCATENATE", v("name"), v("seg")), "name || seg"),
    ("t_lower", lambda: C("LOWER", v("seg")), "lower(seg)"),
    ("t_trim", lambda: C("TRIM", F.concat(F.lit("  "), v("seg"), F.lit("   x "))), "seg || ' x'"),
    ("t_clean", lambda: C("CLEAN", F.concat(v("seg"), F.lit("\t\n\x07"), v("key"))), "seg || key"),
    ("t_char", lambda: C("CHAR", v("key") % 26 + 65), "chr(CAST(key % 26 + 65 AS INTEGER))"),
    ("t_unichar", lambda: C("UNICHAR", v("key") % 2000 + 900), "chr(CAST(key % 2000 + 900 AS INTEGER))"),
    ("f_lenb", lambda: C("LENB", F.concat(v("seg"), F.lit("日本"))), "length(seg) + 4"),
    ("t_asc", lambda: C("ASC", F.translate(v("seg"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "ＡＢＣＤＥＦＧＨＩＪＫＬＭＮＯＰＱＲＳＴＵＶＷＸＹＺ")), "seg"),
    ("t_replace", lambda: C("REPLACE", v("name"), 3, 4, "*"), "substring(name, 1, 2) || '*' || substring(name, 7)"),
    ("t_textafter", lambda: C("TEXTAFTER", v("name"), "#"), "split_part(name, '#', 2)"),
    ("t_t", lambda: C("T", v("seg")), "seg"),
    ("t_t_number", lambda: C("T", v("bal"), "double"), "''"),
    ("t_hyperlink", lambda: C("HYPERLINK", "https://example.com", v("seg")), "seg"),
    ("t_valuetotext", lambda: C("VALUETOTEXT", F.concat(v("seg"), F.lit('"')), 1), "'\"' || seg || '\"\"\"'"),
    ("t_arraytotext", lambda: C("ARRAYTOTEXT", F.array(v("key"), v("key") + 1), 1), "'{' || key || ',' || (key + 1) || '}'"),
    ("t_fixed", lambda: C("FIXED", v("key") * 1.5, 1, True), "printf('%.1f', key * 1.5)"),
    ("t_fixed_groups", lambda: C("FIXED", v("key") * 1000, 0), "format('{:,d}', key * 1000)"),
    ("t_dollar", lambda: C("DOLLAR", v("key") * 250.25 - 1000, 2), "CASE WHEN key * 250.25 < 1000 THEN '($' || format('{:,.2f}', CAST(1000 - key * 250.25 AS DOUBLE)) || ')' ELSE '$' || format('{:,.2f}', CAST(key * 250.25 - 1000 AS DOUBLE)) END"),
    ("t_yen", lambda: C("YEN", v("key") * 1000), "'¥' || format('{:,d}', key * 1000)"),
    ("f_numbervalue", lambda: C("NUMBERVALUE", F.concat(v("key"), F.lit("."), F.lit("125,5%")), ",", "."), "CAST(key || '125.5' AS DOUBLE) / 100"),
])

_S = "(date_diff('day', DATE '1899-12-30', CAST(o_orderdate AS DATE)))"
_columns("values_dates", "orders", ["o_orderkey"], {"dt": "CAST(o_orderdate AS DATE)", "key": "o_orderkey", "sec": "o_orderkey * 37 % 86400"}, [
    ("f_date", lambda: C("DATE", F.year("dt"), F.month("dt"), F.dayofmonth("dt")), _S),
    ("f_date_rolled", lambda: C("DATE", F.year("dt"), F.month("dt") + 14, 0), "date_diff('day', DATE '1899-12-30', last_day(dt + INTERVAL 13 MONTH))"),
    ("f_time", lambda: C("TIME", 0, 0, v("sec")) * 86400, "sec"),
    ("f_hour", lambda: C("HOUR", serial(v("dt")) + v("sec") / 86400), "sec // 3600"),
    ("f_minute", lambda: C("MINUTE", serial(v("dt")) + v("sec") / 86400), "sec // 60 % 60"),
    ("f_second", lambda: C("SECOND", serial(v("dt")) + v("sec") / 86400), "sec % 60"),
    ("f_datevalue", lambda: C("DATEVALUE", F.date_format("dt", "M/d/yyyy")), _S),
    ("f_timevalue", lambda: C("TIMEVALUE", F.date_format(F.timestamp_seconds(v("sec")), "h:mm:ss a")) * 86400, "sec"),
    ("f_networkdays_intl", lambda: C("NETWORKDAYS.INTL", serial(v("dt")), serial(v("dt")) + v("key") % 40, 7), "len([i FOR i IN range(0, key % 40 + 1) IF isodow(dt + CAST(i AS INTEGER)) NOT IN (5, 6)])"),
    ("f_networkdays_text", lambda: C("NETWORKDAYS.INTL", serial(v("dt")), serial(v("dt")) + v("key") % 40, "1000001"), "len([i FOR i IN range(0, key % 40 + 1) IF isodow(dt + CAST(i AS INTEGER)) NOT IN (1, 7)])"),
    ("f_workday", lambda: C("WORKDAY", serial(v("dt")), v("key") % 9 + 1), _S + " + [i FOR i IN range(1, 40) IF isodow(dt + CAST(i AS INTEGER)) < 6][key % 9 + 1]"),
    ("f_workday_intl", lambda: C("WORKDAY.INTL", serial(v("dt")), -(v("key") % 9 + 1), 11), _S + " - [i FOR i IN range(1, 40) IF isodow(dt - CAST(i AS INTEGER)) < 7][key % 9 + 1]"),
    ("f_weeknum", lambda: C("WEEKNUM", serial(v("dt"))), "(dayofyear(dt) - 1 + dayofweek(date_trunc('year', dt))) // 7 + 1"),
    ("f_weeknum_monday", lambda: C("WEEKNUM", serial(v("dt")), 2), "(dayofyear(dt) - 1 + isodow(date_trunc('year', dt)) - 1) // 7 + 1"),
    ("f_days360", lambda: C("DAYS360", serial(v("dt")), serial(v("dt")) + v("key") % 400, True), "(year(dt + CAST(key % 400 AS INTEGER)) - year(dt)) * 360 + (month(dt + CAST(key % 400 AS INTEGER)) - month(dt)) * 30 + least(day(dt + CAST(key % 400 AS INTEGER)), 30) - least(day(dt), 30)"),
    ("b_today", lambda: C("TODAY") >= serial(v("dt")), "true"),
    ("b_now", lambda: (C("NOW") - C("TODAY")).between(0, 1), "true"),
])


def _gamma_p(a: str, x: str, terms: int = 120) -> str:
    """SQL of the lower regularised incomplete gamma function, by its series of positive terms."""
    return f"list_sum([exp(({a} + i) * ln({x}) - ({x}) - lgamma({a} + i + 1)) FOR i IN range(0, {terms})])"


def _beta_i(x: str, a: str, b: str, terms: int = 400) -> str:
    """SQL of the regularised incomplete beta function, by its series of positive terms (x well below 1)."""
    return f"list_sum([exp(({a}) * ln({x}) + ({b}) * ln(1 - ({x})) + lgamma(({a}) + ({b}) + i) - lgamma({b}) - lgamma(({a}) + 1 + i) + i * ln({x})) FOR i IN range(0, {terms})])"


def _phi(x: str) -> str:
    """SQL of the normal distribution, as half an incomplete gamma function of the square."""
    return f"(CASE WHEN {x} = 0 THEN 0.5 ELSE 0.5 + sign({x}) * 0.5 * {_gamma_p('0.5', f'(({x}) * ({x}) / 2)')} END)"


_choose = lambda n, k: f"exp(lgamma({n} + 1) - lgamma({k} + 1) - lgamma({n} - ({k}) + 1))"
_DIST = _PART | {"y": "CAST(p_size / 10.0 AS DOUBLE)", "n": "p_size % 9"}

_columns("values_normal", "part", ["p_partkey"], _DIST, [
    ("f_norm_dist", lambda: C("NORM.DIST", v("r"), 950, 40, True), _phi("((r - 950) / 40)")),
    ("f_normdist", lambda: C("NORMDIST", v("r"), 950, 40, False), "exp(-0.5 * ((r - 950) / 40) ** 2) / sqrt(2 * pi()) / 40"),
    ("f_norm_s_dist", lambda: C("NORM.S.DIST", v("x"), True), _phi("x")),
    ("f_normsdist", lambda: C("NORMSDIST", v("x")), _phi("x")),
    ("f_norm_inv", lambda: C("NORM.DIST", C("NORM.INV", v("u"), 10, 3), 10, 3, True), "u"),
    ("f_norminv", lambda: C("NORMINV", C("NORMDIST", v("x"), 1, 2, True), 1, 2), "x"),
    ("f_norm_s_inv", lambda: C("NORM.S.INV", C("NORM.S.DIST", v("x"), True)), "x"),
    ("f_normsinv", lambda: C("NORMSINV", C("NORMSDIST", v("x"))), "x"),
    ("f_gauss", lambda: C("GAUSS", v("x")), _phi("x") + " - 0.5"),
    ("f_phi", lambda: C("PHI", v("x")), "exp(-x * x / 2) / sqrt(2 * pi())"),
    ("f_confidence", lambda: C("NORMSDIST", C("CONFIDENCE", v("u"), 2, 16) * 2), "1 - u / 2"),
    ("f_confidence_norm", lambda: C("NORMSDIST", C("CONFIDENCE.NORM", v("u"), 2, 16) * 2), "1 - u / 2"),
    ("f_erf", lambda: C("ERF", v("x")), "2 * " + _phi("(x * sqrt(2))") + " - 1"),
    ("f_erf_between", lambda: C("ERF", 0.5, v("y")), "2 * " + _phi("(y * sqrt(2))") + " - 2 * " + _phi("(0.5 * sqrt(2))")),
    ("f_erf_precise", lambda: C("ERF.PRECISE", v("x")), "2 * " + _phi("(x * sqrt(2))") + " - 1"),
    ("f_erfc", lambda: C("ERFC", v("x")), "2 - 2 * " + _phi("(x * sqrt(2))")),
    ("f_erfc_precise", lambda: C("ERFC.PRECISE", v("x")), "2 - 2 * " + _phi("(x * sqrt(2))")),
    ("f_lognorm_dist", lambda: C("LOGNORM.DIST", v("y"), 0.5, 1.5, True), _phi("((ln(y) - 0.5) / 1.5)")),
    ("f_lognorm_density", lambda: C("LOGNORM.DIST", v("y"), 0.5, 1.5, False), "exp(-0.5 * ((ln(y) - 0.5) / 1.5) ** 2) / (y * 1.5 * sqrt(2 * pi()))"),
    ("f_lognormdist", lambda: C("LOGNORMDIST", v("y"), 0.5, 1.5), _phi("((ln(y) - 0.5) / 1.5)")),
    ("f_lognorm_inv", lambda: C("LOGNORM.INV", C("LOGNORMDIST", v("y"), 0.5, 1.5), 0.5, 1.5), "y"),
    ("f_loginv", lambda: C("LOGINV", C("LOGNORMDIST", v("y"), 0.5, 1.5), 0.5, 1.5), "y"),
    ("f_expon_dist", lambda: C("EXPON.DIST", v("y"), 0.7, True), "1 - exp(-0.7 * y)"),
    ("f_expondist", lambda: C("EXPONDIST", v("y"), 0.7, False), "0.7 * exp(-0.7 * y)"),
    ("f_weibull_dist", lambda: C("WEIBULL.DIST", v("y"), 1.5, 2, True), "1 - exp(-((y / 2) ** 1.5))"),
    ("f_weibull", lambda: C("WEIBULL", v("y"), 1.5, 2, False), "1.5 / 2 * (y / 2) ** 0.5 * exp(-((y / 2) ** 1.5))"),
])

_columns("values_gamma", "part", ["p_partkey"], _DIST, [
    ("f_gammaln", lambda: C("GAMMALN", v("y")), "lgamma(y)"),
    ("f_gammaln_precise", lambda: C("GAMMALN.PRECISE", v("y")), "lgamma(y)"),
    ("f_gamma", lambda: C("GAMMA", v("y")), "gamma(y)"),
    ("f_gamma_dist", lambda: C("GAMMA.DIST", v("y"), 2.5, 1.5, True), _gamma_p("2.5", "(y / 1.5)")),
    ("f_gammadist", lambda: C("GAMMADIST", v("y"), 2.5, 1.5, False), "exp(1.5 * ln(y) - y / 1.5 - lgamma(2.5) - 2.5 * ln(1.5))"),
    ("f_gamma_inv", lambda: C("GAMMA.INV", C("GAMMA.DIST", v("y"), 2.5, 1.5, True), 2.5, 1.5), "y"),
    ("f_gammainv", lambda: C("GAMMAINV", C("GAMMA.DIST", v("y"), 2.5, 1.5, True), 2.5, 1.5), "y"),
    ("f_chisq_dist", lambda: C("CHISQ.DIST", v("y"), 3, True), _gamma_p("1.5", "(y / 2)")),
    ("f_chisq_density", lambda: C("CHISQ.DIST", v("y"), 3, False), "exp(0.5 * ln(y) - y / 2 - lgamma(1.5) - 1.5 * ln(2))"),
    ("f_chisq_dist_rt", lambda: C("CHISQ.DIST.RT", v("y"), 3), "1 - " + _gamma_p("1.5", "(y / 2)")),
    ("f_chidist", lambda: C("CHIDIST", v("y"), 5), "1 - " + _gamma_p("2.5", "(y / 2)")),
    ("f_chisq_inv", lambda: C("CHISQ.INV", C("CHISQ.DIST", v("y"), 3, True), 3), "y"),
    ("f_chisq_inv_rt", lambda: C("CHISQ.INV.RT", C("CHISQ.DIST.RT", v("y"), 3), 3), "y"),
    ("f_chiinv", lambda: C("CHIINV", C("CHIDIST", v("y"), 3), 3), "y"),
    ("f_poisson_dist", lambda: C("POISSON.DIST", v("n"), v("y"), True), "list_sum([exp(i * ln(y) - y - lgamma(i + 1)) FOR i IN range(0, n + 1)])"),
    ("f_poisson", lambda: C("POISSON", v("n"), v("y"), False), "exp(n * ln(y) - y - lgamma(n + 1))"),
    ("f_binom_dist", lambda: C("BINOM.DIST", v("n"), 12, v("u"), True), "list_sum([" + _choose("12", "i") + " * u ** i * (1 - u) ** (12 - i) FOR i IN range(0, n + 1)])"),
    ("f_binomdist", lambda: C("BINOMDIST", v("n"), 12, v("u"), False), _choose("12", "n") + " * u ** n * (1 - u) ** (12 - n)"),
    ("f_binom_inv", lambda: C("BINOM.INV", 12, v("u"), 0.6), "list_min([k FOR k IN range(0, 13) IF list_sum([" + _choose("12", "i") + " * u ** i * (1 - u) ** (12 - i) FOR i IN range(0, k + 1)]) >= 0.6])"),
    ("f_critbinom", lambda: C("CRITBINOM", 12, v("u"), 0.6), "list_min([k FOR k IN range(0, 13) IF list_sum([" + _choose("12", "i") + " * u ** i * (1 - u) ** (12 - i) FOR i IN range(0, k + 1)]) >= 0.6])"),
    ("f_negbinom_dist", lambda: C("NEGBINOM.DIST", v("n"), 4, v("u"), True), "list_sum([" + _choose("(i + 3)", "3") + " * u ** 4 * (1 - u) ** i FOR i IN range(0, n + 1)])"),
    ("f_negbinomdist", lambda: C("NEGBINOMDIST", v("n"), 4, v("u")), _choose("(n + 3)", "3") + " * u ** 4 * (1 - u) ** n"),
    ("f_hypgeom_dist", lambda: C("HYPGEOM.DIST", v("n"), 9, 15, 40, True), "list_sum([" + _choose("15", "i") + " * " + _choose("25", "(9 - i)") + " / " + _choose("40", "9") + " FOR i IN range(0, n + 1)])"),
    ("f_hypgeomdist", lambda: C("HYPGEOMDIST", v("n"), 9, 15, 40), _choose("15", "n") + " * " + _choose("25", "(9 - n)") + " / " + _choose("40", "9")),
])

_T = _beta_i("(y * y / (7 + y * y))", "0.5", "3.5")  # of 7 degrees: the chance between -y and y
_F = _beta_i("(4 * y / (4 * y + 9))", "2", "4.5")
_columns("values_beta", "part", ["p_partkey"], _DIST, [
    ("f_beta_dist", lambda: C("BETA.DIST", v("u"), 2, 3, True), _beta_i("u", "2", "3")),
    ("f_beta_density", lambda: C("BETA.DIST", v("u"), 2, 3, False), "12 * u * (1 - u) ** 2"),
    ("f_betadist", lambda: C("BETADIST", v("y"), 2, 3, 0, 6), _beta_i("(y / 6)", "2", "3")),
    ("f_beta_inv", lambda: C("BETA.INV", C("BETA.DIST", v("u"), 2, 3, True), 2, 3), "u"),
    ("f_betainv", lambda: C("BETAINV", C("BETA.DIST", v("u"), 2, 3, True), 2, 3), "u"),
    ("f_t_dist", lambda: C("T.DIST", v("y"), 7, True), "0.5 + 0.5 * " + _T),
    ("f_t_density", lambda: C("T.DIST", v("y"), 7, False), "exp(lgamma(4.0) - lgamma(3.5)) / sqrt(7 * pi()) * (1 + y * y / 7) ** (-4)"),
    ("f_t_dist_2t", lambda: C("T.DIST.2T", v("y"), 7), "1 - " + _T),
    ("f_t_dist_rt", lambda: C("T.DIST.RT", v("y"), 7), "0.5 - 0.5 * " + _T),
    ("f_tdist", lambda: C("TDIST", v("y"), 7, 1), "0.5 - 0.5 * " + _T),
    ("f_t_inv", lambda: C("T.INV", C("T.DIST", v("x"), 7, True), 7), "x"),
    ("f_t_inv_2t", lambda: C("T.INV.2T", C("T.DIST.2T", v("y"), 7), 7), "y"),
    ("f_tinv", lambda: C("TINV", C("T.DIST.2T", v("y"), 7), 7), "y"),
    ("f_f_dist", lambda: C("F.DIST", v("y"), 4, 9, True), _F),
    ("f_f_density", lambda: C("F.DIST", v("y"), 4, 9, False), "exp(lgamma(6.5) - lgamma(2.0) - lgamma(4.5) + 2 * ln(4.0 / 9) + ln(y) - 6.5 * ln(1 + 4 * y / 9))"),
    ("f_f_dist_rt", lambda: C("F.DIST.RT", v("y"), 4, 9), "1 - " + _F),
    ("f_fdist", lambda: C("FDIST", v("y"), 4, 9), "1 - " + _F),
    ("f_f_inv", lambda: C("F.INV", C("F.DIST", v("y"), 4, 9, True), 4, 9), "y"),
    ("f_f_inv_rt", lambda: C("F.INV.RT", C("F.DIST.RT", v("y"), 4, 9), 4, 9), "y"),
    ("f_finv", lambda: C("FINV", C("FDIST", v("y"), 4, 9), 4, 9), "y"),
])

#: A loan of a part's price over s + 1 periods at (k % 9 + 1) per cent.
_LOAN = _PART | {"i": "CAST(p_partkey % 9 + 1 AS DOUBLE) / 100", "n": "p_size + 1", "m": "p_size // 2 + 1"}
_PMT = "(r * i / (1 - (1 + i) ** (-n)))"
_LEFT = lambda k: f"(r * (1 + i) ** ({k}) - {_PMT} * ((1 + i) ** ({k}) - 1) / i)"  # noqa: E731  owed after k payments
_columns("values_finance", "part", ["p_partkey"], _LOAN | {"m": "CAST(FLOOR(p_size / 2) AS INT) + 1"}, [
    ("f_nper", lambda: C("NPER", v("i"), C("PMT", v("i"), v("n"), v("r")), v("r")), "n"),
    ("f_ipmt", lambda: C("IPMT", v("i"), v("m"), v("n"), v("r")), "-i * " + _LEFT("m - 1")),
    ("f_ppmt", lambda: C("PPMT", v("i"), v("m"), v("n"), v("r")), f"i * {_LEFT('m - 1')} - {_PMT}"),
    ("f_cumipmt", lambda: C("CUMIPMT", v("i"), v("n"), v("r"), 1, v("m")), f"-({_PMT} * m - (r - {_LEFT('m')}))"),
    ("f_cumprinc", lambda: C("CUMPRINC", v("i"), v("n"), v("r"), 1, v("m")), f"-(r - {_LEFT('m')})"),
    ("f_rate", lambda: C("RATE", v("n"), C("PMT", v("i"), v("n"), v("r")), v("r")), "i"),
    ("f_ispmt", lambda: C("ISPMT", v("i"), v("m"), v("n"), v("r")), "r * i * (m / CAST(n AS DOUBLE) - 1)"),
    ("f_db", lambda: C("DB", v("r") * 10, 100, 6, 3, 12), "r * 10 * (1 - round(1 - pow(100 / (r * 10), 1.0 / 6), 3)) ** 2 * round(1 - pow(100 / (r * 10), 1.0 / 6), 3)"),
    ("f_ddb", lambda: C("DDB", v("r") * 10, 0, 10, v("s") % 9 + 1), "r * 10 * 0.8 ** (s % 9) * 0.2"),
    ("f_vdb", lambda: C("VDB", v("r") * 10, 0, 10, 0, v("s") % 5 + 1), "r * 10 * (1 - 0.8 ** (s % 5 + 1))"),
    ("f_pduration", lambda: C("PDURATION", v("i"), v("r"), v("r") * 2), "ln(2) / ln(1 + i)"),
    ("f_rri", lambda: C("RRI", v("n"), v("r"), v("r") * 3), "3.0 ** (1.0 / n) - 1"),
    ("f_nominal", lambda: C("NOMINAL", C("EFFECT", v("i"), 12), 12), "i"),
    ("f_dollarde", lambda: C("DOLLARDE", F.floor(v("r")) + (v("s") % 16) / 100, 16), "floor(r) + (s % 16) / 16.0"),
    ("f_dollarfr", lambda: C("DOLLARFR", F.floor(v("r")) + (v("s") % 16) / 16, 16), "floor(r) + (s % 16) / 100.0"),
])

#: Securities that settle on the order's day and mature on 15 June 2010; day-count basis 3 is actual / 365.
_BOND = {"dt": "CAST(o_orderdate AS DATE)", "tp": "CAST(o_orderkey % 7 + 2 AS DOUBLE) / 100", "yd": "CAST(o_orderkey % 5 + 3 AS DOUBLE) / 100", "bill": "CAST(o_orderkey % 180 + 1 AS INT)"}
_MATURE = "DATE '2010-06-15'"
_N = "CAST(ceil(((2010 - year(dt)) * 12 + 6 - month(dt) + (15 - day(dt)) / 100.0) / 6) AS INTEGER)"
_COUPON = lambda back: f"({_MATURE} - to_months(6 * ({back})))"
_DAYS = lambda a, b: f"date_diff('day', CAST({a} AS DATE), CAST({b} AS DATE))"
_GONE = f"({_DAYS(_COUPON(_N), 'dt')} / CAST({_DAYS(_COUPON(_N), _COUPON(_N + ' - 1'))} AS DOUBLE))"
_WORTH = f"list_sum([(50 * tp + CASE WHEN j = {_N} - 1 THEN 100 ELSE 0 END) / (1 + yd / 2) ** (j + 1 - {_GONE}) FOR j IN range(0, {_N})])"
_LONG = f"list_sum([(j + 1 - {_GONE}) * (50 * tp + CASE WHEN j = {_N} - 1 THEN 100 ELSE 0 END) / (1 + yd / 2) ** (j + 1 - {_GONE}) FOR j IN range(0, {_N})]) / {_WORTH} / 2"
_YEARS = f"({_DAYS('dt', _MATURE)} / 365.0)"
_ser = lambda: serial(v("dt"))
_M = 40344  # the serial of the day of maturity
_columns("values_bonds", "orders", ["o_orderkey"], _BOND, [
    ("f_coupnum", lambda: C("COUPNUM", _ser(), _M, 2, 1), _N),
    ("f_couppcd", lambda: C("COUPPCD", _ser(), _M, 2, 1), _DAYS("DATE '1899-12-30'", _COUPON(_N))),
    ("f_coupncd", lambda: C("COUPNCD", _ser(), _M, 2, 1), _DAYS("DATE '1899-12-30'", _COUPON(_N + " - 1"))),
    ("f_coupdays", lambda: C("COUPDAYS", _ser(), _M, 2, 1), _DAYS(_COUPON(_N), _COUPON(_N + " - 1"))),
    ("f_coupdaybs", lambda: C("COUPDAYBS", _ser(), _M, 2, 1), _DAYS(_COUPON(_N), "dt")),
    ("f_coupdaysnc", lambda: C("COUPDAYSNC", _ser(), _M, 2, 1), _DAYS("dt", _COUPON(_N + " - 1"))),
    ("f_price", lambda: C("PRICE", _ser(), _M, v("tp"), v("yd"), 100, 2, 1), f"{_WORTH} - 50 * tp * {_GONE}"),
    ("f_yield", lambda: C("YIELD", _ser(), _M, v("tp"), C("PRICE", _ser(), _M, v("tp"), v("yd"), 100, 2, 1), 100, 2, 1), "yd"),
    ("f_duration", lambda: C("DURATION", _ser(), _M, v("tp"), v("yd"), 2, 1), _LONG),
    ("f_mduration", lambda: C("MDURATION", _ser(), _M, v("tp"), v("yd"), 2, 1), f"{_LONG} / (1 + yd / 2)"),
    ("f_accrint", lambda: C("ACCRINT", _ser(), _M, _M, v("tp"), 1000, 2, 3), f"1000 * tp * {_YEARS}"),
    ("f_disc", lambda: C("DISC", _ser(), _M, 60, 100, 3), f"0.4 / {_YEARS}"),
    ("f_intrate", lambda: C("INTRATE", _ser(), _M, 60, 100, 3), f"40 / 60.0 / {_YEARS}"),
    ("f_received", lambda: C("RECEIVED", _ser(), _M, 60, 0.02, 3), f"60 / (1 - 0.02 * {_YEARS})"),
    ("f_pricedisc", lambda: C("PRICEDISC", _ser(), _M, 0.02, 100, 3), f"100 * (1 - 0.02 * {_YEARS})"),
    ("f_yielddisc", lambda: C("YIELDDISC", _ser(), _M, 60, 100, 3), f"40 / 60.0 / {_YEARS}"),
    ("f_pricemat", lambda: C("PRICEMAT", _ser(), _M, _ser() - 365, v("tp"), v("yd"), 3), f"100 * (1 + ({_YEARS} + 1) * tp) / (1 + {_YEARS} * yd) - 100 * tp"),
    ("f_yieldmat", lambda: C("YIELDMAT", _ser(), _M, _ser() - 365, v("tp"), C("PRICEMAT", _ser(), _M, _ser() - 365, v("tp"), v("yd"), 3), 3), "yd"),
    ("f_tbillprice", lambda: C("TBILLPRICE", _ser(), _ser() + v("bill"), v("tp")), "100 * (1 - tp * bill / 360)"),
    ("f_tbillyield", lambda: C("TBILLYIELD", _ser(), _ser() + v("bill"), 97), "3 / 97.0 * 360 / bill"),
    ("f_tbilleq", lambda: C("TBILLEQ", _ser(), _ser() + v("bill"), v("tp")), "365 * tp / (360 - tp * bill)"),
])

_based = lambda n, b: f"upper(to_base({n}, {b}))"
_columns("values_bases", "part", ["p_partkey"], _PART, [
    ("f_bin2dec", lambda: C("BIN2DEC", F.bin("s")), "s"),
    ("f_hex2dec", lambda: C("HEX2DEC", F.hex("k")), "k"),
    ("f_oct2dec", lambda: C("OCT2DEC", F.conv("k", 10, 8)), "k"),
    ("t_dec2oct", lambda: C("DEC2OCT", v("k")), _based("k", 8)),
    ("t_bin2hex", lambda: C("BIN2HEX", F.bin("s")), _based("s", 16)),
    ("t_bin2oct", lambda: C("BIN2OCT", F.bin("s")), _based("s", 8)),
    ("t_hex2bin", lambda: C("HEX2BIN", F.hex("s")), _based("s", 2)),
    ("t_hex2oct", lambda: C("HEX2OCT", F.hex("k")), _based("k", 8)),
    ("t_oct2bin", lambda: C("OCT2BIN", F.conv("s", 10, 8)), _based("s", 2)),
    ("t_oct2hex", lambda: C("OCT2HEX", F.conv("k", 10, 8)), _based("k", 16)),
    ("t_dec2bin_below", lambda: C("DEC2BIN", -v("s")), "to_base(1024 - s, 2)"),
])

#: Of a + bi: each function's real and imaginary parts, or those of what it is one over.
_COMPLEX = {
    "IMSQRT": ("(a * a + b * b) ** 0.25 * cos(atan2(b, a) / 2)", "(a * a + b * b) ** 0.25 * sin(atan2(b, a) / 2)"),
    "IMEXP": ("exp(a) * cos(b)", "exp(a) * sin(b)"),
    "IMLN": ("ln(a * a + b * b) / 2", "atan2(b, a)"),
    "IMLOG10": ("ln(a * a + b * b) / 2 / ln(10)", "atan2(b, a) / ln(10)"),
    "IMLOG2": ("ln(a * a + b * b) / 2 / ln(2)", "atan2(b, a) / ln(2)"),
    "IMSIN": ("sin(a) * cosh(b)", "cos(a) * sinh(b)"),
    "IMCOS": ("cos(a) * cosh(b)", "-sin(a) * sinh(b)"),
    "IMTAN": ("sin(2 * a) / (cos(2 * a) + cosh(2 * b))", "sinh(2 * b) / (cos(2 * a) + cosh(2 * b))"),
    "IMSINH": ("sinh(a) * cos(b)", "cosh(a) * sin(b)"),
    "IMCOSH": ("cosh(a) * cos(b)", "sinh(a) * sin(b)"),
}
_over = lambda f: tuple(f"{sign}({part}) / (({_COMPLEX[f][0]}) ** 2 + ({_COMPLEX[f][1]}) ** 2)" for sign, part in zip(("", "-"), _COMPLEX[f]))
_COMPLEX |= {"IMSEC": _over("IMCOS"), "IMCSC": _over("IMSIN"), "IMCOT": _over("IMTAN"), "IMSECH": _over("IMCOSH"), "IMCSCH": _over("IMSINH")}
_z = lambda: v("z")
_w = lambda: C("COMPLEX", 2, -0.5)
_COMPLEX_OF = {f.lower(): lambda f=f: C(f, _z()) for f in _COMPLEX} | {
    "imconjugate": lambda: C("IMCONJUGATE", _z()), "imsum": lambda: C("IMSUM", _z(), _w()), "imsub": lambda: C("IMSUB", _z(), _w()), "imdiv": lambda: C("IMDIV", _z(), _w()), "impower": lambda: C("IMPOWER", _z(), 3),
}
_both = lambda name, re_, im: [(f"f_{name}_re", lambda: C("IMREAL", v(name)), re_), (f"f_{name}_im", lambda: C("IMAGINARY", v(name)), im)]
_columns("values_complex", "part", ["p_partkey"], {"a": "CAST(p_size % 10 - 5 AS DOUBLE) / 4", "b": "CAST(p_partkey % 7 + 1 AS DOUBLE) / 4"}, [
    *[c for name, (re_, im) in _COMPLEX.items() for c in _both(name.lower(), re_, im)],
    *_both("imconjugate", "a", "-b"),
    *_both("imsum", "a + 2", "b - 0.5"),
    *_both("imsub", "a - 2", "b + 0.5"),
    *_both("imdiv", "(2 * a - 0.5 * b) / 4.25", "(2 * b + 0.5 * a) / 4.25"),
    *_both("impower", "a ** 3 - 3 * a * b * b", "3 * a * a * b - b ** 3"),
    ("f_imargument", lambda: C("IMARGUMENT", _z()), "atan2(b, a)"),
], steps=[{"z": lambda: C("COMPLEX", v("a"), v("b"))}, _COMPLEX_OF])

_flat = lambda m: F.array_join(F.flatten(m).cast("array<string>"), ",", "-")
_line = lambda a: F.array_join(a.cast("array<string>"), ",", "-")
_list = lambda *x: "array_to_string([" + ", ".join(f"CAST({e} AS VARCHAR)" for e in x) + "], ',')"
_abc = lambda: F.array(v("k"), v("s"), v("k") + v("s"))
_rows = lambda: F.array(F.array(v("k"), v("s")), F.array(v("s") * 2, v("k") * 3), F.array(F.lit(1).cast("bigint"), v("k") + 7))
_square = lambda: F.array(F.array(v("x"), F.lit(2.0)), F.array(F.lit(1.0), v("x") * v("x") + 3))
_columns("values_arrays", "part", ["p_partkey"], {"s": "CAST(p_size AS BIGINT)", "k": "p_partkey", "x": "p_size / CAST(10 AS DOUBLE)"}, [
    ("t_sequence", lambda: _line(C("SEQUENCE", 3, v("k"), v("s"))), _list("k", "k + s", "k + 2 * s")),
    ("t_transpose", lambda: _flat(C("TRANSPOSE", _rows())), _list("k", "s * 2", "1", "s", "k * 3", "k + 7")),
    ("t_sortby", lambda: _line(C("SORTBY", _abc(), F.array(F.lit(3), F.lit(1), F.lit(2)))), _list("s", "k + s", "k")),
    ("t_filter", lambda: _line(C("FILTER", _abc(), F.array(F.lit(True), F.lit(False), F.lit(True)))), _list("k", "k + s")),
    ("t_drop", lambda: _line(C("DROP", _abc(), 1)), _list("s", "k + s")),
    ("t_drop_end", lambda: _line(C("DROP", _abc(), -1)), _list("k", "s")),
    ("t_chooserows", lambda: _flat(C("CHOOSEROWS", _rows(), 3, -3)), _list("1", "k + 7", "k", "s")),
    ("t_choosecols", lambda: _flat(C("CHOOSECOLS", _rows(), 2)), _list("s", "k * 3", "k + 7")),
    ("t_tocol", lambda: _line(C("TOCOL", _rows(), True)), _list("k", "s * 2", "1", "s", "k * 3", "k + 7")),
    ("t_torow", lambda: _line(C("TOROW", _rows())), _list("k", "s", "s * 2", "k * 3", "1", "k + 7")),
    ("t_expand", lambda: _line(C("EXPAND", _abc(), 5, v("s"))), _list("k", "s", "k + s", "s", "s")),
    ("t_vstack", lambda: _line(C("VSTACK", _abc(), _abc())), _list("k", "s", "k + s", "k", "s", "k + s")),
    ("t_hstack", lambda: _line(F.transform(C("HSTACK", _abc(), F.array(v("s"), v("k"), v("k"))), lambda e: e["0"] * 2 + e["1"])), _list("2 * k + s", "2 * s + k", "3 * k + 2 * s")),
    ("t_wraprows", lambda: _flat(C("WRAPROWS", _abc(), 2, v("s"))), _list("k", "s", "k + s", "s")),
    ("t_wrapcols", lambda: _flat(C("WRAPCOLS", _abc(), 2, v("s"))), _list("k", "k + s", "s", "s")),
    ("t_map", lambda: _line(C("MAP", _abc(), lambda e: e * 2)), _list("k * 2", "s * 2", "(k + s) * 2")),
    ("t_byrow", lambda: _line(C("BYROW", _rows(), lambda e: F.get(e, F.lit(0)) - F.get(e, F.lit(1)))), _list("k - s", "s * 2 - k * 3", "-6 - k")),
    ("t_bycol", lambda: _line(C("BYCOL", _rows(), lambda e: F.array_max(e))), _list("greatest(k, s * 2, 1)", "greatest(s, k * 3, k + 7)")),
    ("t_scan", lambda: _line(C("SCAN", F.lit(0).cast("bigint"), _abc(), lambda a, e: a + e)), _list("k", "k + s", "2 * k + 2 * s")),
    ("t_makearray", lambda: _flat(C("MAKEARRAY", 2, 2, lambda i, j: v("k") * i + j)), _list("k + 1", "k + 2", "2 * k + 1", "2 * k + 2")),
    ("t_address", lambda: C("ADDRESS", v("k") + 1, v("s")), "'$' || CASE WHEN s > 26 THEN 'A' || chr(CAST(s - 26 + 64 AS INTEGER)) ELSE chr(CAST(s + 64 AS INTEGER)) END || '$' || (k + 1)"),
    ("f_columns", lambda: C("COLUMNS", _rows()), "2"),
    ("f_row", lambda: C("ROW", "k"), "k + 1"),
    ("f_areas", lambda: C("AREAS", v("k"), v("s")), "2"),
    ("f_sheet", lambda: C("SHEET", ["Data", "Other"], "other"), "2"),
    ("f_sheets", lambda: C("SHEETS", ["Data", "Other"]), "2"),
    ("f_mdeterm", lambda: C("MDETERM", _square()), "x * (x * x + 3) - 2"),
    ("f_minverse", lambda: F.element_at(F.flatten(C("MINVERSE", _square())), 2), "-2 / (x * (x * x + 3) - 2)"),
    ("f_mmult", lambda: F.element_at(F.flatten(C("MMULT", _square(), _square())), 4), "2 + (x * x + 3) ** 2"),
    ("t_cell", lambda: C("CELL", "type", F.struct(v("p_name").alias("text"), F.lit("string").alias("kind"), F.lit("A").alias("col"), F.lit("1").alias("row"))), "'l'"),
])


def _number(alias: str, digits: int = 6) -> Column:
    return F.round(F.col(alias).cast("double"), digits).alias(alias)


_T_TEST = _beta_i("(t * t / (df + t * t))", "0.5", "(df / 2)", 300)
_F_TEST = _beta_i("(a * f / (a * f + b))", "(a / 2)", "(b / 2)", 2500)


@query(f"""WITH g AS (SELECT s_nationkey, count(*) AS n, avg(l_tax - l_discount * 0.8) AS d, stddev_samp(l_tax - l_discount * 0.8) AS sd, avg(l_tax) AS mx, avg(l_discount * 0.8) AS my,
    var_samp(l_tax) AS vx, var_samp(l_discount * 0.8) AS vy, avg(l_quantity) AS mq, stddev_samp(l_quantity) AS sq, sum((l_linenumber - 4) ** 2 / 4.0) / 100 AS chi
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL),
paired AS (SELECT s_nationkey, CAST(n - 1 AS DOUBLE) AS df, d / (sd / sqrt(n)) AS t FROM g),
pooled AS (SELECT s_nationkey, CAST(2 * n - 2 AS DOUBLE) AS df, (mx - my) / sqrt((vx + vy) / 2 * 2 / n) AS t FROM g),
welch AS (SELECT s_nationkey, (vx / n + vy / n) ** 2 / ((vx / n) ** 2 / (n - 1) + (vy / n) ** 2 / (n - 1)) AS df, (mx - my) / sqrt(vx / n + vy / n) AS t FROM g),
ratio AS (SELECT s_nationkey, vx / vy AS f, CAST(n - 1 AS DOUBLE) AS a, CAST(n - 1 AS DOUBLE) AS b FROM g)
SELECT s_nationkey, (SELECT round(1 - {_T_TEST}, 6) FROM paired x WHERE x.s_nationkey = g.s_nationkey) AS t_test_paired,
  (SELECT round(1 - {_T_TEST}, 6) FROM pooled x WHERE x.s_nationkey = g.s_nationkey) AS ttest_equal, (SELECT round((1 - {_T_TEST}) / 2, 6) FROM welch x WHERE x.s_nationkey = g.s_nationkey) AS t_test_welch,
  (SELECT round(2 * least({_F_TEST}, 1 - {_F_TEST}), 6) FROM ratio x WHERE x.s_nationkey = g.s_nationkey) AS f_test, round(1 - {_phi("((mq - 25.5) / (sq / sqrt(n)))")}, 6) AS z_test,
  round(1 - {_phi("((mq - 25.5) / (14 / sqrt(n)))")}, 6) AS ztest, round(1 - {_gamma_p("4.0", "(chi / 2)", 300)}, 6) AS chisq_test FROM g""")
def stats_tests(spark, d):
    """Each test's statistic is an aggregate; its p-value is taken from the grouped rows."""
    rows = table(spark, d, "lineitem").join(table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    tax, off = F.col("l_tax"), F.col("l_discount") * 0.8
    tests = {
        "t_test_paired": C("T.TEST", tax, off, 2, 1), "ttest_equal": C("TTEST", tax, off, 2, 2), "t_test_welch": C("T.TEST", tax, off, 1, 3), "f_test": C("F.TEST", tax, off),
        "z_test": C("Z.TEST", F.col("l_quantity"), 25.5), "ztest": C("ZTEST", F.col("l_quantity"), 25.5, 14),
    }
    statistic, chance = C("CHISQ.TEST", F.col("l_linenumber"), F.lit(4), 8)
    tests["chisq_test"] = (statistic / 100, chance)
    out = rows.groupBy("s_nationkey").agg(*[a.alias(n) for n, (a, _) in tests.items()])
    out = out.select("s_nationkey", *[f(F.col(n)).alias(n) for n, (_, f) in tests.items()])
    return out.select("s_nationkey", *[_number(n) for n in tests])


@query("""WITH f AS (SELECT l_linestatus, regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a, exp(regr_slope(ln(l_extendedprice), l_quantity)) AS m,
    exp(regr_intercept(ln(l_extendedprice), l_quantity)) AS c FROM lineitem GROUP BY 1)
SELECT l_orderkey, l_linenumber, l_partkey, round(a + b * l_quantity, 3) AS trend, round(c * m ** l_quantity, 3) AS growth, round(m, 8) AS logest FROM lineitem JOIN f USING (l_linestatus)""")
def stats_trend_and_growth(spark, d):
    """LOGEST, TREND and GROWTH by line status over all lines."""
    rows = table(spark, d, "lineitem")
    line = C("LINEST", rows, ["l_linestatus"], "l_extendedprice", ["l_quantity"])
    curve = C("LOGEST", rows, ["l_linestatus"], "l_extendedprice", ["l_quantity"])
    out = C("TREND", rows, line, ["l_linestatus"], ["l_quantity"], name="trend")
    out = C("GROWTH", out, curve, ["l_linestatus"], ["l_quantity"])
    out = out.join(curve.select("l_linestatus", F.col("l_quantity").alias("logest")), "l_linestatus")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", _number("trend", 3), _number("growth", 3), _number("logest", 8))


@query("""SELECT c_nationkey, round(sum(c_acctbal * 1.1 ** (-(c_custkey % 900) / 365.0)), 3) AS xnpv, true AS irr_is_root, true AS xirr_is_root,
  round((sum(CASE WHEN c_acctbal > 0 THEN c_acctbal * 1.02 ** (59 - c_custkey % 60) END) / -sum(CASE WHEN c_acctbal < 0 THEN c_acctbal / 1.01 ** (c_custkey % 60) END)) ** (1 / 59.0) - 1, 6) AS mirr
FROM customer GROUP BY 1""")
def finance_flows(spark, d):
    """XNPV and MIRR in SQL; IRR and XIRR by the present value at the rate found, which has to be 0."""
    rows = table(spark, d, "customer").withColumn("at", F.col("c_custkey") % 60).withColumn("years", (F.col("c_custkey") % 900) / 365)
    rows = rows.withColumn("flow", F.when(F.col("at") == 0, -F.abs("c_acctbal") * 20).otherwise(F.abs("c_acctbal")))
    both = C("IRR", rows, ["c_nationkey"], "flow", "at").join(C("XIRR", rows, ["c_nationkey"], "flow", "years", name="xirr"), "c_nationkey", "full")
    b = F.col("c_acctbal")
    worth = lambda rate, at: F.coalesce(F.abs(F.sum(F.col("flow") / F.pow(1 + F.col(rate), F.col(at)))) < 1e-3 * F.sum(F.abs("flow")), F.lit(True))
    out = rows.join(both, "c_nationkey").groupBy("c_nationkey").agg(
        C("XNPV", 0.1, b, F.col("c_custkey") % 900).alias("xnpv"), worth("irr", "at").alias("irr_is_root"), worth("xirr", "years").alias("xirr_is_root"),
        C("MIRR", b, F.col("at"), 0.01, 0.02, F.lit(60)).alias("mirr"),
    )
    return out.select("c_nationkey", _number("xnpv", 3), "irr_is_root", "xirr_is_root", _number("mirr"))


_PRICES = "(SELECT p_brand, p_retailprice AS price, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS ord FROM part)"


def _priced(spark, d):
    """Parts numbered within their brand, and lines that ask for a price of a part's brand."""
    part = table(spark, d, "part")
    place = F.row_number().over(Window.partitionBy("p_brand").orderBy("p_partkey")) - 1
    lines = table(spark, d, "orders").select("o_orderkey", F.concat(F.lit("Brand#"), F.col("o_orderkey") % 5 + 1).alias("p_brand"), (F.round(F.col("o_totalprice") / 100) % 200 + 890).alias("asked"))
    return lines, part.select("p_brand", F.col("p_retailprice").alias("price"), place.alias("ord"))


_ASKED = "(SELECT o_orderkey, 'Brand#' || (o_orderkey % 5 + 1) AS p_brand, round(o_totalprice / 100) % 200 + 890 AS asked FROM orders)"


@query(f"""WITH few AS (SELECT p_brand, price, min(ord) + 1 AS first, max(ord) + 1 AS last FROM {_PRICES} GROUP BY 1, 2)
SELECT a.o_orderkey, (SELECT arg_max(first, price) FROM few f WHERE f.p_brand = a.p_brand AND price <= asked) AS smaller, (SELECT arg_min(last, price) FROM few f WHERE f.p_brand = a.p_brand AND price >= asked) AS larger,
  (SELECT arg_max(last, price) FROM few f WHERE f.p_brand = a.p_brand AND price <= asked) AS match_rising, (SELECT max(price) FROM few f WHERE f.p_brand = a.p_brand AND price <= asked) AS price
FROM {_ASKED} a""")
def lookup_positions(spark, d):
    """XMATCH -1 and 1 (the latter from the end), MATCH 1 and XLOOKUP -1 within brands."""
    lines, parts = _priced(spark, d)
    out = C("XMATCH", lines, "asked", parts, "price", "ord", -1, by=["p_brand"], name="smaller")
    out = C("XMATCH", out, "asked", parts, "price", "ord", 1, True, by=["p_brand"], name="larger")
    out = C("MATCH", out, "asked", parts, "price", "ord", 1, by=["p_brand"], name="match_rising")
    out = C("XLOOKUP", out, "asked", parts.withColumn("found", F.col("price")), "price", ["found"], "ord", -1, by=["p_brand"])
    return out.select("o_orderkey", "smaller", "larger", "match_rising", F.col("found").alias("price"))


@query("""WITH c AS (SELECT c_name, c_nationkey AS k, c_custkey AS ord FROM customer), f AS (SELECT k, min(ord) + 1 AS first, max(ord) + 1 AS last, arg_max(c_name, ord) AS newest FROM c GROUP BY 1)
SELECT n_nationkey, first, last, coalesce(newest, 'none') AS newest, first AS match_equal FROM (SELECT n_nationkey * 2 AS k, n_nationkey FROM nation) LEFT JOIN f USING (k)""")
def lookup_positions_exact(spark, d):
    """XMATCH 0 from both ends, MATCH 0 and XLOOKUP from the end with a value if not found; half of the keys are missing."""
    asked = table(spark, d, "nation").select("n_nationkey", (F.col("n_nationkey") * 2).alias("k"))
    people = table(spark, d, "customer").select(F.col("c_nationkey").alias("key"), F.col("c_custkey").alias("ord"), F.col("c_name").alias("newest"))
    out = C("XMATCH", asked, "k", people, "key", "ord", name="first")
    out = C("XMATCH", out, "k", people, "key", "ord", 0, True, name="last")
    out = C("MATCH", out, "k", people, "key", "ord", 0, name="match_equal")
    return C("XLOOKUP", out, "k", people, "key", ["newest"], "ord", 0, True, {"newest": "none"}).drop("k")


@query("""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN p WHEN 1 THEN f WHEN 2 THEN o ELSE -1 END AS held FROM orders,
(SELECT count(*) FILTER (WHERE o_orderstatus = 'P') AS p, count(*) FILTER (WHERE o_orderstatus = 'F') AS f, count(*) FILTER (WHERE o_orderstatus = 'O') AS o FROM orders WHERE o_orderpriority = '1-URGENT')""")
def lookup_across(spark, d):
    """HLOOKUP in a table of priorities by status; names compare without case, an unknown one gives -1."""
    orders = table(spark, d, "orders")
    wide = orders.groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).count()
    asked = orders.select("o_orderkey", F.element_at(F.array(*map(F.lit, "pfox")), (F.col("o_orderkey") % 4 + 1).cast("int")).alias("status"))
    return C("HLOOKUP", asked, "status", wide, "o_orderpriority", "1-URGENT", ["F", "O", "P"], "held", -1).select("o_orderkey", "held")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, lead(l_quantity, 2) OVER w AS two_down, lag(l_tax, 1) OVER w AS one_up FROM lineitem
WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_tax, l_extendedprice)""")
def window_offset(spark, d):
    """OFFSET as rows further down and up within an order."""
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_tax", "l_extendedprice")
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", C("OFFSET", v("l_quantity"), 2, w).alias("two_down"), C("OFFSET", v("l_tax"), -1, w).alias("one_up"))


@query("""SELECT l_shipmonth, count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT l_suppkey) FILTER (WHERE l_quantity > 45) AS large FROM (SELECT *, month(l_shipdate) AS l_shipmonth FROM lineitem) GROUP BY 1""")
def stats_distinct_count(spark, d):
    """The idiom SUMPRODUCT(1 / COUNTIF(range, range)): a count of distinct values, with and without a condition."""
    lines = table(spark, d, "lineitem").withColumn("l_shipmonth", F.month("l_shipdate"))
    return lines.groupBy("l_shipmonth").agg(C("DISTINCTCOUNT", v("l_suppkey")).alias("suppliers"), C("DISTINCTCOUNT", v("l_suppkey"), v("l_quantity"), ">45").alias("large"))


@query("SELECT o_orderstatus, o_totalprice, n FROM (SELECT o_orderstatus, round(o_totalprice / 1000) AS o_totalprice, count(*) AS n FROM orders GROUP BY 1, 2) QUALIFY n > 1 AND n = max(n) OVER (PARTITION BY o_orderstatus)")
def stats_modes(spark, d):
    """MODE.MULT: all of the values met most, by status."""
    rounded = table(spark, d, "orders").withColumn("o_totalprice", F.round(F.col("o_totalprice") / 1000))
    return C("MODE.MULT", rounded, "o_totalprice", "o_orderkey", ["o_orderstatus"]).select("o_orderstatus", "o_totalprice", "n")


@query("SELECT count(*) AS n, sum(r_regionkey) AS keys FROM region")
def lookup_indirect(spark, d):
    """INDIRECT: a named range is a view."""
    table(spark, d, "region").createOrReplaceTempView("gridloom_named_range")
    return C("INDIRECT", spark, "gridloom_named_range").agg(F.count("*").alias("n"), F.sum("r_regionkey").alias("keys"))


@query(f"""SELECT c_custkey, round({_phi("x")}, 6) AS norm, round(1 - {_beta_i("(x * x / (10 + x * x))", "0.5", "5.0")}, 6) AS t, round(1 - {_gamma_p("2.0", "(abs(x) * 5)")}, 6) AS chi,
  round(1 - {_beta_i("(3 * abs(x) / (3 * abs(x) + 12))", "1.5", "6.0")}, 6) AS f, round(list_sum([{_choose("10", "i")} * 0.4 ** i * 0.6 ** (10 - i) FOR i IN range(0, c_custkey % 11 + 1)]), 6) AS binom,
  round(exp((c_custkey % 8) * ln(2.5) - 2.5 - lgamma(c_custkey % 8 + 1)), 6) AS poisson, round(6 * y ** 2 - 8 * y ** 3 + 3 * y ** 4, 6) AS beta
FROM (SELECT *, c_acctbal / 10000 AS x, abs(c_acctbal / 10000) % 1 AS y FROM customer)""")
def distribution_probabilities(spark, d):
    """Tail and point probabilities of seven distributions at every customer's balance."""
    x = F.col("c_acctbal") / 10000
    out = table(spark, d, "customer").select(
        "c_custkey", C("NORM.S.DIST", x).alias("norm"), C("T.DIST.2T", F.abs(x), 10).alias("t"), C("CHISQ.DIST.RT", F.abs(x) * 10, 4).alias("chi"), C("F.DIST.RT", F.abs(x), 3, 12).alias("f"),
        C("BINOM.DIST", F.col("c_custkey") % 11, 10, 0.4, True).alias("binom"), C("POISSON.DIST", F.col("c_custkey") % 8, 2.5, False).alias("poisson"), C("BETA.DIST", F.abs(x) % 1, 2, 3, True).alias("beta"),
    )
    return out.select("c_custkey", *[_number(n) for n in out.columns[1:]])


_LEFT_OVER = "CAST(ceil((120 + month(due) - 7 + (day(due) - 6) / 100.0) / 6) AS INTEGER)"
_SINCE = f"(((2009 - year(due - to_months(6 * {_LEFT_OVER}))) * 360 + (7 - month(due - to_months(6 * {_LEFT_OVER}))) * 30 + 6 - day(due)) / 180.0)"


@query(f"""SELECT l_orderkey, l_linenumber, true AS rate_solves, price, coupons FROM lineitem JOIN (SELECT n, {_LEFT_OVER} AS coupons,
  round(list_sum([(2.5 + CASE WHEN j = {_LEFT_OVER} - 1 THEN 100 ELSE 0 END) / CAST(1.03 AS DOUBLE) ** (j + 1 - {_SINCE}) FOR j IN range(0, {_LEFT_OVER})]) - 2.5 * {_SINCE}, 6) AS price
  FROM (SELECT n, DATE '1899-12-30' + CAST(43650 + n * 10 AS INTEGER) AS due FROM range(1, 8) t(n))) ON l_linenumber = n""")
def finance_solvers(spark, d):
    """RATE by the annuity's present value at the rate found, which has to be that of the loan; bond prices by 30/360."""
    n = F.col("l_linenumber")
    out = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", C("RATE", 24 + n, -(200 + n), 4000).alias("rate"), C("PRICE", 40000, 43650 + n * 10, 0.05, 0.06, 100, 2, 0).alias("price"), C("COUPNUM", 40000, 43650 + n * 10, 2).cast("int").alias("coupons"),
    )
    solves = F.abs(C("PV", F.col("rate"), 24 + n, -(200 + n)) - 4000) < 1e-5
    return out.select("l_orderkey", "l_linenumber", solves.alias("rate_solves"), _number("price"), "coupons")
