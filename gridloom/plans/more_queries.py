"""Further queries: quantiles and ranks, database functions, parsing, markup, stacked arrays, bonds and tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.functions import arrays, call, stats
from gridloom.functions.dates import serial
from gridloom.operators import lookup, profile, ranges
from gridloom.operators.criteria import database
from gridloom.plans.registry import query
from gridloom.plans.tables import table
from gridloom.sources.markup import markdown_blocks


@query("""SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.25), 4) AS q1, round(quantile_cont(l_extendedprice, 0.75), 4) AS q3, max(l_quantity) AS large1, min(l_quantity) AS small1,
  round(sum(CASE WHEN l_quantity BETWEEN 5 AND 10 THEN l_discount ELSE 0 END), 4) AS prob, round(sum(l_quantity ** 2 - l_tax ** 2), 3) AS x2my2, round(sum((l_quantity - l_tax) ** 2), 3) AS xmy2,
  round(skewness(l_quantity) * (count(*) - 2) / sqrt(count(*) * (count(*) - 1.0)), 6) AS skewp, count(*) FILTER (WHERE l_tax IS NULL) AS blanks FROM lineitem GROUP BY 1""")
def stats_quantiles(spark, d):
    x, q, t = F.col("l_extendedprice"), F.col("l_quantity"), F.col("l_tax")
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(
        F.round(call("QUARTILE", x, 1), 4).alias("q1"), F.round(call("QUARTILE.INC", x, 3), 4).alias("q3"), call("MAX", q).alias("large1"), call("MIN", q).alias("small1"),
        F.round(call("PROB", q, F.col("l_discount"), 5, 10), 4).alias("prob"), F.round(call("SUMX2MY2", q, t), 3).alias("x2my2"), F.round(call("SUMXMY2", q, t), 3).alias("xmy2"),
        F.round(call("SKEW.P", q), 6).alias("skewp"), call("COUNTBLANK", t).alias("blanks"),
    )


@query("""SELECT c_custkey, CAST(rank() OVER w AS INT) AS rank_eq, rank() OVER w + (count(*) OVER (PARTITION BY c_nationkey, c_acctbal) - 1) / 2.0 AS rank_avg,
  floor(percent_rank() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal) * 1000 + 1e-9) / 1000 AS percent FROM customer WINDOW w AS (PARTITION BY c_nationkey ORDER BY c_acctbal DESC)""")
def stats_ranks_by_key(spark, d):
    x, k = F.col("c_acctbal"), ["c_nationkey"]
    return table(spark, d, "customer").select("c_custkey", call("RANK", x, False, k).alias("rank_eq"), call("RANK.AVG", x, False, k).alias("rank_avg"), call("PERCENTRANK", x, 3, k).alias("percent"))


@query("""SELECT o_orderstatus, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC) AS k FROM orders) WHERE k = 3""")
def stats_third_largest(spark, d):
    return stats.kth(table(spark, d, "orders"), ["o_orderstatus"], "o_totalprice", 3)


@query("""SELECT l_linestatus, count(l_quantity) AS dcount FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 49 GROUP BY 1""")
def database_count(spark, d):
    return database(table(spark, d, "lineitem"), "DCOUNT", "l_quantity", [{"l_returnflag": "r", "l_quantity": ">=49"}], ["l_linestatus"])


@query("""SELECT round(avg(l_tax), 8) AS mean, max(l_discount) AS top, min(l_discount) AS low, round(stddev_samp(l_quantity), 6) AS sd, round(var_pop(l_quantity), 6) AS vp FROM lineitem WHERE l_linenumber = 2 OR l_quantity > 45""")
def database_aggregates(spark, d):
    rows = [{"l_linenumber": 2}, {"l_quantity": ">45"}]
    names = {"mean": ("DAVERAGE", "l_tax", 8), "top": ("DMAX", "l_discount", 8), "low": ("DMIN", "l_discount", 8), "sd": ("DSTDEV", "l_quantity", 6), "vp": ("DVARP", "l_quantity", 6)}
    return table(spark, d, "lineitem").agg(*[F.round(call(f, x, rows), k).alias(n) for n, (f, x, k) in names.items()])


@query("""SELECT event_id, CAST(CASE WHEN event_id % 3 = 0 THEN event_id * 1.5 WHEN event_id % 3 = 1 THEN event_id / 100.0 END AS DOUBLE) AS value,
  regexp_replace(event_type, '[aeiou]', '*', 'g') AS masked, event_type LIKE '%c%' AS has_c, upper(event_type[1]) || event_type[2:] AS proper FROM events""")
def text_parsing(spark, d):
    m, k = F.col("event_id") % 3, F.col("event_id")
    raw = F.when(m == 0, F.concat(F.lit("$"), F.format_string("%,.1f", k * 1.5))).when(m == 1, F.concat(k.cast("string"), F.lit("%"))).otherwise("n/a")
    t = F.col("event_type")
    return table(spark, d, "events").select("event_id", call("VALUE", raw).alias("value"), call("REGEXREPLACE", t, "[aeiou]", "*").alias("masked"), call("REGEXTEST", t, "c").alias("has_c"), call("PROPER", t).alias("proper"))


@query("""SELECT p_partkey, split_part(p_name, ' ', 1) AS first, length(p_name) - length(replace(p_name, ' ', '')) + 1 AS parts, CASE WHEN strpos(lower(p_name), '_') > 0 THEN strpos(lower(p_name), '_') END AS under,
  reverse(p_brand)[1:1] AS last, printf('%08.2f', p_retailprice) AS padded, CAST(floor(p_retailprice) AS BIGINT) % 2 = 0 AS even FROM part""")
def text_splitting(spark, d):
    n, x = F.col("p_name"), F.col("p_retailprice")
    parts = call("TEXTSPLIT", n, " ")
    return table(spark, d, "part").select(
        "p_partkey", call("INDEX", parts, 1).alias("first"), F.size(parts).alias("parts"), call("SEARCH", "_", n).alias("under"), call("RIGHT", F.col("p_brand"), 1).alias("last"),
        call("TEXT", x, "00000.00").alias("padded"), call("ISEVEN", x).alias("even"),
    )


@query("""WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS a, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 900 AS INT) AS b FROM orders),
m AS (SELECT *, (year(b) - year(a)) * 12 + month(b) - month(a) - CASE WHEN day(b) < day(a) THEN 1 ELSE 0 END AS m FROM o)
SELECT o_orderkey, CAST(date_diff('day', a, b) AS DOUBLE) AS days, CAST(m // 12 AS DOUBLE) AS years, CAST(m AS DOUBLE) AS months, CAST(m % 12 AS DOUBLE) AS beyond_years, round(date_diff('day', a, b) / 365, 8) AS frac3,
  isodow(a) % 7 + 1 AS wd1, dayofyear(b) AS doy FROM m""")
def dates_differences(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("a"))
    o = o.withColumn("b", F.date_add("a", (F.col("o_orderkey") % 900).cast("int")))
    a, b = serial(F.col("a")), serial(F.col("b"))
    whole = {name: call("DATEDIF", a, b, unit) for name, unit in (("years", "Y"), ("months", "M"), ("beyond_years", "YM"))}
    return o.select("o_orderkey", call("DAYS", b, a).cast("double").alias("days"), *[x.alias(name) for name, x in whole.items()], F.round(call("YEARFRAC", a, b, 3), 8).alias("frac3"), call("WEEKDAY", a).alias("wd1"), F.dayofyear("b").alias("doy"))


@query("""SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN '#NUM!' WHEN s_suppkey % 5 = 0 THEN '#N/A' END IS NOT NULL AS is_error, coalesce(s_suppkey % 5 = 0 AND s_acctbal >= 0, FALSE) AS is_na,
  CASE WHEN s_acctbal < 0 THEN 6 WHEN s_suppkey % 5 = 0 THEN 7 END AS kind FROM supplier""")
def logic_errors(spark, d):
    err = F.when(F.col("s_acctbal") < 0, "#NUM!").when(F.col("s_suppkey") % 5 == 0, "#N/A")
    return table(spark, d, "supplier").select("s_suppkey", call("ISERROR", err).alias("is_error"), call("ISNA", err).alias("is_na"), call("ERROR.TYPE", err).alias("kind"))


@query("""SELECT coalesce(a.place, b.place) AS place, n_name, r_name FROM (SELECT n_name, row_number() OVER (ORDER BY n_nationkey) - 1 AS place FROM nation) a FULL JOIN (SELECT r_name, row_number() OVER (ORDER BY r_regionkey) - 1 AS place FROM region) b ON a.place = b.place""")
def array_stack_columns(spark, d):
    n = arrays.numbered(table(spark, d, "nation").select("n_name", "n_nationkey"), ["n_nationkey"], name="place").drop("n_nationkey")
    r = arrays.numbered(table(spark, d, "region").select("r_name", "r_regionkey"), ["r_regionkey"], name="place").drop("r_regionkey")
    return arrays.stack_columns(n, r, "place")


@query("""SELECT o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS k FROM orders) WHERE k BETWEEN 10 AND 29""")
def array_take_and_drop(spark, d):
    rows = arrays.numbered(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"])
    return arrays.rows_between(rows, 10, 30).select("o_orderkey", "o_totalprice")


@query("""SELECT o_custkey, o_orderkey, round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING), 2) AS finish,
  round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) - o_totalprice, 2) AS start FROM orders""")
def range_waterfall(spark, d):
    out = ranges.waterfall(table(spark, d, "orders"), ["o_custkey"], "o_orderkey", "o_totalprice")
    return out.select("o_custkey", "o_orderkey", F.round("end", 2).alias("finish"), F.round("start", 2).alias("start"))


@query("""SELECT event_id, 'k' AS key, json_extract_string(props, '$.k') AS value FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL""")
def import_json_fields(spark, d):
    return profile.flatten_json(table(spark, d, "events").select("event_id", "props"), "props", "k string, ref struct<page:string>").select("event_id", "key", "value")


@query("""SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING'""")
def lookup_then_slice(spark, d):
    building = ranges.slicer(table(spark, d, "customer"), "c_mktsegment", ["BUILDING"])
    found = lookup.exact(table(spark, d, "orders"), "o_custkey", building, "c_custkey", ["c_name"], "c_custkey")
    return found.where("c_name is not null").select("o_orderkey", "c_name")


@query("""SELECT conv_id, turn, 0 AS ord, 'heading' AS kind, 2 AS level, 'T' || turn AS text FROM conversations
UNION ALL SELECT conv_id, turn, 1, 'quote', 1, 'said by ' || role FROM conversations
UNION ALL SELECT conv_id, turn, 2, 'paragraph', 0, regexp_replace(text, '\\s*\\n\\s*', ' ', 'g') FROM conversations WHERE trim(text) <> ''""")
def markup_paragraphs(spark, d):
    """Kind, level and text of the blocks of a small Markdown document around every turn."""
    turns = table(spark, d, "conversations")
    body = F.concat(F.lit("## T"), F.col("turn"), F.lit(" ##\n> said by "), F.col("role"), F.lit("\n\n"), F.coalesce("text", F.lit("")))
    return markdown_blocks(turns.select("conv_id", "turn", body.alias("body")), "body", ["conv_id", "turn"])
