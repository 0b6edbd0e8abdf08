"""Lookups, selectors, range operations, profiles, documents and windows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridloom.operators import lookup, profile, ranges, selectors
from gridloom.operators.criteria import database
from gridloom.functions import arrays, stats
from gridloom.plans.registry import query
from gridloom.plans.tables import table
from gridloom.sources.delimited import typed_cell
from gridloom.streaming.windows import windowed


@query("""SELECT s_suppkey, s_name, coalesce(n_name, '?') AS nation FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""")
def lookup_exact(spark, d):
    nation = table(spark, d, "nation").select("n_nationkey", F.col("n_name").alias("nation"))
    return lookup.exact(table(spark, d, "supplier"), "s_nationkey", nation, "n_nationkey", ["nation"], "n_nationkey", default={"nation": "?"}).select("s_suppkey", "s_name", "nation")


@query("""WITH f AS (SELECT o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS first_order, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS last_order FROM orders GROUP BY 1)
SELECT c_custkey, coalesce(first_order, -1) AS first_order, coalesce(last_order, -1) AS last_order FROM customer LEFT JOIN f ON c_custkey = o_custkey""")
def lookup_first_and_last(spark, d):
    orders = table(spark, d, "orders").withColumn("o", F.struct("o_orderdate", "o_orderkey"))
    c = table(spark, d, "customer").select("c_custkey")
    c = lookup.exact(c, "c_custkey", orders.withColumn("first_order", F.col("o_orderkey")), "o_custkey", ["first_order"], "o", default={"first_order": -1})
    return lookup.exact(c, "c_custkey", orders.withColumn("last_order", F.col("o_orderkey")), "o_custkey", ["last_order"], "o", last=True, default={"last_order": -1})


@query("""WITH e AS (SELECT * FROM events WHERE event_type = 'purchase'), v AS (SELECT user_id AS u, ts AS t, max(event_id) AS view_id FROM events WHERE event_type = 'view' GROUP BY 1, 2)
SELECT event_id, view_id FROM e ASOF LEFT JOIN v ON e.user_id = v.u AND e.ts >= v.t""")
def lookup_as_of_backward(spark, d):
    e = table(spark, d, "events")
    views = e.where("event_type = 'view'").select("user_id", F.col("ts").alias("t"), F.col("event_id").alias("view_id"))
    return lookup.as_of(e.where("event_type = 'purchase'"), "ts", views, "t", ["view_id"], ["user_id"], order="view_id").select("event_id", "view_id")


@query("""WITH e AS (SELECT * FROM events WHERE event_type = 'view'), v AS (SELECT user_id AS u, ts AS t, min(event_id) AS purchase_id FROM events WHERE event_type = 'purchase' GROUP BY 1, 2)
SELECT event_id, purchase_id FROM e ASOF LEFT JOIN v ON e.user_id = v.u AND e.ts <= v.t""")
def lookup_as_of_forward(spark, d):
    e = table(spark, d, "events")
    buys = e.where("event_type = 'purchase'").select("user_id", F.col("ts").alias("t"), F.col("event_id").alias("purchase_id"))
    return lookup.as_of(e.where("event_type = 'view'"), "ts", buys, "t", ["purchase_id"], ["user_id"], "forward", order="purchase_id").select("event_id", "purchase_id")


@query("""SELECT p_partkey, CASE WHEN p_type ILIKE '%omy' THEN 'brass' WHEN p_type ILIKE '%sm__l%' THEN 'steel' WHEN p_type ILIKE 'promo%' THEN 'promo' END AS metal FROM part""")
def lookup_wildcard(spark, d):
    return lookup.wildcard(table(spark, d, "part"), {"*omy": "brass", "*sm??l*": "steel", "promo*": "promo"}, "p_type", "metal").select("p_partkey", "metal")


@query("SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)")
def lookup_exists(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return lookup.matching(table(spark, d, "customer"), orders, ["c_custkey"]).select("c_custkey")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 200000)")
def lookup_missing(spark, d):
    """Customers without a large order."""
    orders = table(spark, d, "orders").where("o_totalprice > 200000").select(F.col("o_custkey").alias("c_custkey"))
    return lookup.matching(table(spark, d, "customer"), orders, ["c_custkey"], anti=True).select("c_custkey")


@query("""SELECT * FROM (SELECT o_orderkey, name, value FROM (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus FROM orders)
UNPIVOT (value FOR name IN (o_custkey, o_orderstatus)))""")
def lookup_horizontal(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("o_custkey"), "o_orderstatus")
    return lookup.horizontal(o, ["o_orderkey"], ["o_custkey", "o_orderstatus"]).withColumnRenamed("key", "name")


@query("""SELECT c_custkey, c_name FROM customer WHERE (c_acctbal > 5000 AND c_mktsegment = 'BUILDING') OR NOT (c_acctbal >= 0)""")
def select_rows_where(spark, d):
    return selectors.where_rows(table(spark, d, "customer"), "row[c_acctbal > 5000 and c_mktsegment = building],row[not(col.C_ACCTBAL >= 0)]").select("c_custkey", "c_name")


@query("""SELECT p_partkey FROM part WHERE (contains(lower(p_type), 'econ') OR regexp_matches(p_brand, '#(1|2)[0-9]')) AND p_size <= 20 AND p_size <> 7""")
def select_rows_text(spark, d):
    return selectors.where_rows(table(spark, d, "part"), 'row[p_type ~= Econ or p_brand ~= r"#(1|2)[0-9]"][p_size <= 20 and p_size != 7]').select("p_partkey")


@query("""SELECT DISTINCT conv_id, turn FROM conversations WHERE role = 'assistant' AND contains(lower(text), 'en') UNION SELECT conv_id, turn FROM conversations WHERE turn = 0""")
def select_nodes_union(spark, d):
    c = table(spark, d, "conversations")
    nodes = c.select(F.concat_ws("/", "conv_id", "turn").alias("path"), F.col("conv_id").cast("string").alias("parent_path"), F.col("turn").alias("ord"), F.col("role").alias("type"), "text", F.lit(None).cast("string").alias("style"), F.create_map(F.lit("turn"), F.col("turn").cast("string")).alias("format"), "conv_id", "turn")
    return selectors.select_nodes(nodes, "assistant:contains(en), *[turn=0]").select("conv_id", "turn")


@query("""SELECT l_orderkey, l_linenumber FROM lineitem WHERE (l_returnflag = 'A' OR l_returnflag = 'R') AND NOT (l_quantity BETWEEN 10 AND 40)
  AND l_extendedprice >= (SELECT min(x) FROM (SELECT l_extendedprice AS x FROM lineitem WHERE (l_returnflag = 'A' OR l_returnflag = 'R') AND NOT (l_quantity BETWEEN 10 AND 40) ORDER BY x DESC LIMIT 25))""")
def range_autofilter(spark, d):
    tests = {"l_returnflag": [("equals", "a"), ("equals", "r")], "l_quantity": [("notBetween", 10, 40)], "l_extendedprice": [("top", 25)]}
    return ranges.autofilter(table(spark, d, "lineitem"), tests).select("l_orderkey", "l_linenumber")


@query("""SELECT c_custkey, c_acctbal > 9000 AS high, c_acctbal BETWEEN 0 AND 100 AS low, contains(lower(c_mktsegment), 'build') AS build,
  rank() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC) <= 3 AS top3,
  rank() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal) <= greatest(floor(count(*) OVER (PARTITION BY c_nationkey) * 0.1), 1) AS bottom10,
  c_acctbal > avg(c_acctbal) OVER (PARTITION BY c_nationkey) AS above,
  c_acctbal < avg(c_acctbal) OVER (PARTITION BY c_nationkey) - stddev_pop(c_acctbal) OVER (PARTITION BY c_nationkey) AS far_below,
  count(*) OVER (PARTITION BY c_nationkey, lower(c_mktsegment)) > 1 AS repeated FROM customer""")
def range_conditional_formats(spark, d):
    x, n = F.col("c_acctbal"), ["c_nationkey"]
    return table(spark, d, "customer").select(
        "c_custkey", ranges.cell_is(x, "greaterThan", 9000).alias("high"), ranges.cell_is(x, "between", 0, 100).alias("low"),
        ranges.text_rule(F.col("c_mktsegment"), "containsText", "Build").alias("build"), ranges.top_flag(x, 3, keys=n).alias("top3"),
        ranges.top_flag(x, 10, percent=True, bottom=True, keys=n).alias("bottom10"), ranges.average_flag(x, keys=n).alias("above"),
        ranges.average_flag(x, above=False, deviations=1, keys=n).alias("far_below"), ranges.repeated_flag(F.col("c_mktsegment"), keys=n).alias("repeated"),
    )


@query("""SELECT p_partkey, CASE WHEN hi > lo THEN round((p_retailprice - lo) / (hi - lo), 8) ELSE 0 END AS share, CASE WHEN hi > lo THEN CAST(least(floor((p_retailprice - lo) / (hi - lo) * 5), 4) AS INT) ELSE 0 END AS icon
FROM part JOIN (SELECT p_brand AS b, min(p_retailprice) AS lo, max(p_retailprice) AS hi FROM part GROUP BY 1) ON p_brand = b""")
def range_scales(spark, d):
    """A brand of one price has no scale: its share and icon are 0."""
    out = ranges.scaled(table(spark, d, "part"), "p_retailprice", ["p_brand"])
    return out.select("p_partkey", F.round("share", 8).alias("share"), ranges.icon(F.col("share"), 5).alias("icon"))


@query("""SELECT o_orderkey, o_orderdate >= '1998-01-01' AND o_orderdate < '1998-02-01' AS month, CAST(o_orderdate AS DATE) BETWEEN '1998-01-09' AND '1998-01-15' AS last7,
  CAST(o_orderdate AS DATE) BETWEEN '1998-01-11' AND '1998-01-17' AS week FROM orders""")
def range_dates_occurring(spark, d):
    day, x = dt.date(1998, 1, 15), F.col("o_orderdate")
    return table(spark, d, "orders").select("o_orderkey", ranges.date_occurring(x, "thisMonth", day).alias("month"), ranges.date_occurring(x, "last7Days", day).alias("last7"), ranges.date_occurring(x, "thisWeek", day).alias("week"))


@query("""SELECT count(*) AS n, sum(CAST(coalesce(l_quantity BETWEEN 1 AND 45 AND l_quantity = floor(l_quantity), FALSE) AS INT)) AS whole_ok, sum(CAST(l_discount <= 0.05 AS INT)) AS decimal_ok,
  sum(CAST(lower(l_returnflag) IN ('a', 'n') AS INT)) AS list_ok, sum(CAST(CAST(l_shipdate AS DATE) BETWEEN '1996-01-01' AND '1996-12-31' AS INT)) AS date_ok FROM lineitem""")
def range_validation(spark, d):
    tests = {
        "whole_ok": ranges.valid(F.col("l_quantity"), "whole", "between", 1, 45),
        "decimal_ok": ranges.valid(F.col("l_discount"), "decimal", "lessThanOrEqual", 0.05),
        "list_ok": ranges.valid(F.col("l_returnflag"), "list", a=["A", "N"]),
        "date_ok": ranges.valid(F.col("l_shipdate"), "date", "between", F.lit("1996-01-01").cast("date"), F.lit("1996-12-31").cast("date")),
    }
    return table(spark, d, "lineitem").agg(F.count("*").alias("n"), *[F.sum(t.cast("int")).alias(k) for k, t in tests.items()])


@query("SELECT round(sum(l_extendedprice), 2) AS l_extendedprice, round(avg(l_quantity), 6) AS l_quantity, max(l_discount) AS l_discount, count(l_returnflag) AS l_returnflag FROM lineitem")
def range_totals_row(spark, d):
    out = ranges.totals_row(table(spark, d, "lineitem"), {"l_extendedprice": "sum", "l_quantity": "average", "l_discount": "max", "l_returnflag": "count"})
    return out.withColumn("l_extendedprice", F.round("l_extendedprice", 2)).withColumn("l_quantity", F.round("l_quantity", 6))


@query("""SELECT c_mktsegment, round(total, 2) AS total, round(sum(total) OVER (ORDER BY total DESC, c_mktsegment ROWS UNBOUNDED PRECEDING) / sum(total) OVER (), 8) AS cumulative_share
FROM (SELECT c_mktsegment, sum(c_acctbal) AS total FROM customer GROUP BY 1)""")
def range_pareto(spark, d):
    return ranges.pareto(table(spark, d, "customer"), "c_mktsegment", "c_acctbal").select("c_mktsegment", F.round("total", 2).alias("total"), F.round("cumulative_share", 8).alias("cumulative_share"))


@query("SELECT CAST(least(floor((p_retailprice - 900) / 20), 9) AS INT) AS bin, count(*) AS n FROM part WHERE p_retailprice BETWEEN 900 AND 1100 GROUP BY 1")
def range_histogram(spark, d):
    return ranges.histogram(table(spark, d, "part"), "p_retailprice", 10, 900.0, 1100.0)


@query("""SELECT l_returnflag, min(l_quantity) AS low, quantile_cont(l_quantity, 0.25) AS q1, median(l_quantity) AS median, quantile_cont(l_quantity, 0.75) AS q3, max(l_quantity) AS high, round(avg(l_quantity), 8) AS mean FROM lineitem GROUP BY 1""")
def range_box(spark, d):
    return ranges.box(table(spark, d, "lineitem"), ["l_returnflag"], "l_quantity").withColumn("mean", F.round("mean", 8))


@query("""SELECT event_id, round(sum(value) OVER w, 4) AS running, round(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS 2 PRECEDING), 6) AS moving FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""")
def window_running_and_moving(spark, d):
    e = table(spark, d, "events").withColumn("o", F.struct("ts", "event_id"))
    out = arrays.running(e, "value", "o", ["user_id"]).withColumn("moving", ranges.moving_average(F.col("value"), "o", 3, ["user_id"]))
    return out.select("event_id", F.round("running", 4).alias("running"), F.round("moving", 6).alias("moving"))


@query("""SELECT user_id, string_agg(CAST(sign(value - 50) AS INT), ',' ORDER BY ts, event_id) AS points FROM events GROUP BY 1""")
def window_sparkline(spark, d):
    e = table(spark, d, "events").select("user_id", F.struct("ts", "event_id").alias("o"), (F.col("value") - 50).alias("value"))
    return ranges.sparkline(e, ["user_id"], "o", "value", "winloss").withColumn("points", F.array_join(F.col("points").cast("array<int>").cast("array<string>"), ","))


@query("SELECT * FROM (SELECT o_orderkey, o_orderpriority, o_totalprice, row_number() OVER (ORDER BY o_orderpriority DESC, o_totalprice, o_orderkey) - 1 AS place FROM orders)")
def sort_typed(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return arrays.numbered(o, ["-o_orderpriority", "o_totalprice", "o_orderkey"], name="place")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 40")
def sort_top(spark, d):
    return ranges.sort_rows(table(spark, d, "orders"), "o_totalprice desc", "o_orderkey").select("o_orderkey", "o_totalprice").limit(40)


@query("""SELECT CAST(l_quantity AS INT) AS i, l_linenumber AS j, sum(l_quantity) AS v FROM lineitem GROUP BY 1, 2""")
def array_pivot_cells(spark, d):
    l = table(spark, d, "lineitem")
    return l.groupBy(F.col("l_quantity").cast("int").alias("i"), F.col("l_linenumber").alias("j")).agg(F.sum("l_quantity").alias("v"))


@query("""WITH m AS (SELECT CAST(l_quantity AS INT) AS i, l_linenumber AS j, sum(l_quantity) AS v FROM lineitem GROUP BY 1, 2)
SELECT a.i AS i, b.i AS j, sum(a.v * b.v) AS v FROM m a JOIN m b ON a.j = b.j GROUP BY 1, 2""")
def array_matrix_product(spark, d):
    m = array_pivot_cells(spark, d)
    return arrays.matrix_product(m, m.select(F.col("j").alias("i"), F.col("i").alias("j"), "v"))


@query("SELECT o_custkey, o_orderpriority FROM orders GROUP BY 1, 2 HAVING count(*) = 1")
def array_unique_once(spark, d):
    return arrays.unique_rows(table(spark, d, "orders"), ["o_custkey", "o_orderpriority"], once=True)


@query("SELECT n_nationkey AS k, n_name AS name, NULL::VARCHAR AS extra FROM nation UNION ALL SELECT r_regionkey, r_name, 'r' FROM region")
def array_stack_rows(spark, d):
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name"))
    r = table(spark, d, "region").select(F.col("r_regionkey").alias("k"), F.col("r_name").alias("name"), F.lit("r").alias("extra"))
    return arrays.stack_rows(n, r)


@query("""SELECT l_returnflag, round(sum(l_extendedprice), 2) AS dsum FROM lineitem WHERE (l_quantity > 30 AND l_discount < 0.03) OR l_tax >= 0.08 GROUP BY 1""")
def database_sum(spark, d):
    out = database(table(spark, d, "lineitem"), "DSUM", "l_extendedprice", [{"l_quantity": ">30", "l_discount": "<0.03"}, {"l_tax": ">=0.08"}], ["l_returnflag"])
    return out.withColumn("dsum", F.round("dsum", 2))


@query("""WITH c AS (SELECT event_type, round(value) AS v, count(*) AS n, min(event_id) AS first FROM events WHERE value IS NOT NULL GROUP BY 1, 2),
 m AS (SELECT *, rank() OVER (PARTITION BY event_type ORDER BY n DESC) AS r FROM c)
SELECT event_type, arg_min(v, first) AS v, max(n) AS n FROM m WHERE r = 1 AND n > 1 GROUP BY 1""")
def stats_mode_first_seen(spark, d):
    e = table(spark, d, "events").withColumn("v", F.round("value"))
    return stats.mode_single(e, "v", "event_id", ["event_type"])


@query("""SELECT l_returnflag, round(avg(abs(l_quantity - m)), 8) AS avedev FROM (SELECT *, avg(l_quantity) OVER (PARTITION BY l_returnflag) AS m FROM lineitem) GROUP BY 1""")
def stats_average_deviation(spark, d):
    return stats.average_deviation(table(spark, d, "lineitem"), ["l_returnflag"], "l_quantity").withColumn("avedev", F.round("avedev", 8))


@query("""SELECT l_linestatus, round(avg(x), 6) AS trimmean FROM (SELECT l_linestatus, l_extendedprice AS x, row_number() OVER (PARTITION BY l_linestatus ORDER BY l_extendedprice) AS r, count(*) OVER (PARTITION BY l_linestatus) AS n FROM lineitem)
WHERE r > floor(n * 0.1) AND r <= n - floor(n * 0.1) GROUP BY 1""")
def stats_trimmed_mean(spark, d):
    return stats.trimmed_mean(table(spark, d, "lineitem"), ["l_linestatus"], "l_extendedprice", 0.2).withColumn("trimmean", F.round("trimmean", 6))


@query("""SELECT l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 3) AS base, round(regr_r2(l_extendedprice, l_quantity), 6) AS r2 FROM lineitem GROUP BY 1""")
def stats_linear_fit(spark, d):
    fit = stats.linear_fit(table(spark, d, "lineitem"), ["l_returnflag"], "l_extendedprice", ["l_quantity"])
    return fit.select("l_returnflag", F.round("l_quantity", 4).alias("slope"), F.round("intercept", 3).alias("base"), F.round("r2", 6).alias("r2"))


_KIND = """CASE WHEN x IS NULL OR x = '' THEN 'blank' WHEN x LIKE '=%' THEN 'formula' WHEN regexp_matches(x, '^\\s*[-+]?(\\d+\\.?\\d*|\\.\\d+)([eE][-+]?\\d+)?\\s*$') THEN 'number'
  WHEN regexp_matches(x, '^\\d{4}-\\d{2}-\\d{2}$') AND try_cast(x AS DATE) IS NOT NULL THEN 'date' WHEN upper(x) IN ('TRUE', 'FALSE') THEN 'boolean'
  WHEN regexp_matches(x, '^#(N/A|NAME\\?|NULL!|REF!|VALUE!|NUM!|DIV/0!|SPILL!|CALC!)$') THEN 'error' ELSE 'string' END"""


@query(f"""SELECT name AS "column", p AS position, {", ".join(f"count(*) FILTER (WHERE kind = '{k}') AS {k}" for k in profile.KINDS)}, max(length(x)) AS longest
FROM (SELECT *, {_KIND} AS kind FROM ({" UNION ALL ".join(f"SELECT '{c}' AS name, {i} AS p, CAST({c} AS VARCHAR) AS x FROM documents" for i, c in enumerate(("doc_id", "text", "lang", "source", "n_chars")))}
  UNION ALL SELECT 'when', 5, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) FROM (SELECT o_orderdate FROM orders WHERE o_orderkey IN (SELECT doc_id FROM documents)))) GROUP BY 1, 2""")
def profile_columns(spark, d):
    """All kinds of all columns, with a date beside each document that shares its number with an order."""
    days = table(spark, d, "orders").select(F.col("o_orderkey").alias("doc_id"), F.col("o_orderdate").cast("date").alias("when"))
    return profile.profile(table(spark, d, "documents").join(days, "doc_id", "left")).drop("distinct")


@query("""SELECT lang, count(*) AS texts, CAST(sum(length(text)) AS BIGINT) AS chars, CAST(sum(len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> ''))) AS BIGINT) AS words,
  CAST(sum(CASE WHEN text = '' THEN 0 ELSE len(string_split(text, chr(10))) END) AS BIGINT) AS lines, count(*) FILTER (WHERE text = '') AS empty FROM documents GROUP BY 1""")
def profile_texts(spark, d):
    return profile.text_stats(table(spark, d, "documents"), keys=["lang"])


@query("""SELECT issue, severity, c_custkey FROM (SELECT 'negative' AS issue, 'warning' AS severity, c_custkey FROM customer WHERE c_acctbal < 0 UNION ALL SELECT 'rich', 'info', c_custkey FROM customer WHERE c_acctbal > 9900)""")
def profile_issues(spark, d):
    return profile.issues(table(spark, d, "customer"), "c_custkey", {"negative": ("warning", F.col("c_acctbal") < 0), "rich": ("info", F.col("c_acctbal") > 9900)})


@query("""SELECT c_custkey, 'Dear ' || c_name || ', balance ' || c_mktsegment || '{{missing}}' AS merged, 2 AS replaced, 'missing' AS unresolved FROM customer""")
def template_merge(spark, d):
    out = profile.merge_template(table(spark, d, "customer"), "Dear {{name}}, balance {{ seg.x }}{{missing}}", {"name": F.col("c_name"), "seg.x": F.col("c_mktsegment")})
    return out.select("c_custkey", "merged", "replaced", F.array_join("unresolved", ",").alias("unresolved"))


@query("""SELECT p_partkey, replace(p_type, 'MEDIUM', 'Mid$') AS p_type, CAST((length(p_type) - length(replace(p_type, 'MEDIUM', ''))) / 6 AS INT) AS hits FROM part""")
def find_and_replace(spark, d):
    return ranges.find_replace(table(spark, d, "part"), ["p_type"], "MEDIUM", "Mid$").select("p_partkey", "p_type", F.col("__replaced").alias("hits"))


@query("""SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 'number' WHEN event_id % 4 = 1 THEN 'date' WHEN event_id % 4 = 2 THEN 'boolean' ELSE 'string' END AS kind,
  CASE WHEN event_id % 4 = 0 THEN value END AS num FROM events""")
def import_typed_cells(spark, d):
    m = F.col("event_id") % 4
    raw = F.when(m == 0, F.col("value").cast("string")).when(m == 1, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).when(m == 2, F.lit("true")).otherwise(F.col("event_type"))
    cells = table(spark, d, "events").select("event_id", typed_cell(raw).alias("c"))
    return cells.select("event_id", "c.kind", "c.num")


@query("""SELECT event_type, time_bucket(INTERVAL 1 DAY, ts) AS window_start, round(sum(value), 4) AS total, count(value) AS n FROM events GROUP BY 1, 2""")
def window_tumbling(spark, d):
    e = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    out = windowed(e, ["event_type"], {"total": ("sum", "value"), "n": ("count", "value")}, "1 day")
    return out.select("event_type", F.col("window_start").cast("timestamp_ntz").alias("window_start"), F.round("total", 4).alias("total"), "n")


@query("""WITH s AS (SELECT *, CASE WHEN ts - lag(ts) OVER w < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
 t AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM s)
SELECT user_id, min(ts) AS window_start, count(value) AS n FROM t GROUP BY user_id, k""")
def window_session(spark, d):
    e = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    out = windowed(e, ["user_id"], {"n": ("count", "value")}, "6 hours", kind="session")
    return out.select("user_id", F.col("window_start").cast("timestamp_ntz").alias("window_start"), "n")


@query("""SELECT o_orderkey, rank() OVER (ORDER BY o_totalprice DESC) AS place, rank() OVER (ORDER BY o_totalprice DESC) + (count(*) OVER (PARTITION BY o_totalprice) - 1) / 2 AS shared FROM orders""")
def stats_rank(spark, d):
    """A ranking over all orders, without one window over them."""
    return stats.ranks(table(spark, d, "orders"), "o_totalprice").select("o_orderkey", F.col("rank_eq").alias("place"), F.col("rank_avg").alias("shared"))
