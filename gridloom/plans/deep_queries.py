"""Queries over whole tables whose order, patterns, criteria or files come from data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridloom.functions import call
from gridloom.functions.order_stats import order_statistics
from gridloom.functions.ordered import Fold, scan
from gridloom.operators import batches, criteria_tables, lookup, patterns, profile, ranges, references, selectors, spelling, table_finder
from gridloom.plans.registry import query
from gridloom.plans.tables import table
from gridloom.sources import charset, markup, workbook
from gridloom.staging import scratch


@query("""WITH b AS (
  SELECT event_id, ts, event_type, last_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER (ORDER BY ts, CASE WHEN event_type = 'purchase' THEN 0 ELSE 1 END, event_id ROWS UNBOUNDED PRECEDING) AS bought,
    first_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER (ORDER BY ts, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS next
  FROM events WHERE event_type IN ('view', 'purchase'))
SELECT event_id, bought, next FROM b WHERE event_type = 'view'""")
def scan_as_of_all_events(spark, d):
    """The purchase before and after each view among all users: an as-of lookup without keys."""
    e = table(spark, d, "events").select("event_id", "event_type", "ts")
    bought = e.where("event_type = 'purchase'").select(F.col("event_id").alias("bought"), F.col("ts").alias("t"))
    out = lookup.as_of(e.where("event_type = 'view'"), "ts", bought, "t", ["bought"], order="bought")
    out = lookup.as_of(out, "ts", bought.withColumnRenamed("bought", "next"), "t", ["next"], direction="forward", order="next")
    return out.select("event_id", "bought", "next")


@query("""SELECT l_orderkey, l_linenumber, sum(CAST(l_quantity AS BIGINT)) OVER w AS running, max(l_extendedprice) OVER w AS dearest, count(CASE WHEN l_returnflag = 'R' THEN 1 END) OVER w AS returned,
  sum(CAST(l_quantity AS BIGINT)) OVER (PARTITION BY l_returnflag ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity ROWS UNBOUNDED PRECEDING) AS of_flag
  FROM lineitem WINDOW w AS (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity ROWS UNBOUNDED PRECEDING)""")
def scan_all_lines(spark, d):
    """SCAN over all order lines by date: running totals, the dearest line so far, and totals within three hot keys."""
    t = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_returnflag", F.col("l_quantity").cast("bigint").alias("q"), "l_extendedprice")
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "q"]
    out = scan(t, order, {"running": Fold("sum", F.col("q")), "dearest": Fold("max", F.col("l_extendedprice")), "returned": Fold("count", F.when(F.col("l_returnflag") == "R", 1))})
    out = scan(out, order, {"of_flag": Fold("sum", F.col("q"))}, ["l_returnflag"])
    return out.select("l_orderkey", "l_linenumber", "running", "dearest", "returned", "of_flag")


@query("""WITH s AS (SELECT *, avg(o_totalprice) OVER () + stddev_pop(o_totalprice) OVER () AS line, rank() OVER (ORDER BY o_totalprice DESC) AS r, rank() OVER (ORDER BY o_totalprice) AS up, count(*) OVER () AS n FROM orders)
SELECT o_orderkey, r <= 20 AS top20, up <= greatest(1, n // 10) AS low_tenth, o_totalprice > line AS far_above FROM s""")
def range_flags_of_all_orders(spark, d):
    """Conditional formats of a whole table without keys."""
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    out = ranges.flag_top(o, "o_totalprice", 20, flag="top20")
    out = ranges.flag_top(out, "o_totalprice", 10, percent=True, bottom=True, flag="low_tenth")
    return ranges.flag_average(out, "o_totalprice", deviations=1, flag="far_above").drop("o_totalprice")


@query("""WITH o AS (SELECT o_custkey, list(CAST(floor(o_totalprice) AS BIGINT) ORDER BY o_orderkey) AS a FROM orders GROUP BY o_custkey)
SELECT o_custkey, array_to_string(list_transform(range(1, len(a) + 1), lambda i: list_sum(a[1:i])), ',') AS steps FROM o""")
def array_scan_of_orders(spark, d):
    """SCAN over an array of each customer's order values."""
    o = table(spark, d, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", F.floor("o_totalprice").alias("v")))).alias("a"))
    steps = call("SCAN", F.lit(0).cast("bigint"), F.transform("a", lambda e: e["v"]), lambda held, x: held + x)
    return o.select("o_custkey", F.array_join(steps.cast("array<string>"), ",").alias("steps"))


@query("""SELECT c_custkey, c_acctbal AS number, CAST(0 AS DOUBLE) AS of_text, CASE WHEN c_acctbal > 0 THEN 1.0 ELSE 0.0 END AS of_truth, unicode(c_name) AS code, 3 AS place FROM customer""")
def info_n_unicode_column(spark, d):
    t = table(spark, d, "customer")
    return t.select("c_custkey", call("N", F.col("c_acctbal")).alias("number"), call("N", F.col("c_name")).alias("of_text"), call("N", F.col("c_acctbal") > 0).alias("of_truth"), call("UNICODE", F.col("c_name")).alias("code"), call("COLUMN", t.select("c_custkey", "c_name", "c_acctbal"), "c_acctbal").alias("place"))


def _workbooks(spark, df, name):
    """``df`` as a folder of workbooks."""
    workbook.register(spark)
    where = scratch(spark, name)
    df.write.format("workbook").mode("overwrite").save(where)
    return where


@query("""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, o_orderpriority FROM orders""")
def workbook_orders(spark, d):
    """All orders written to workbooks and read back as a typed table, dates by their number format."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_orderpriority")
    return spark.read.format("workbook").schema(o.schema).option("header", True).load(_workbooks(spark, o, "orders_book")).withColumn("o_orderdate", F.col("o_orderdate").cast("string"))


@query("""WITH c AS (SELECT unnest([1, 2, 3, 4]) AS col, unnest(['number', 'string', 'number', 'boolean']) AS kind, unnest([c_custkey, NULL, c_acctbal, NULL]) AS num, unnest([NULL, c_name, NULL, upper(CAST(c_acctbal > 0 AS VARCHAR))]) AS text FROM customer)
SELECT col, kind, count(*) AS cells, round(coalesce(sum(num), 0), 2) AS total, count(DISTINCT text) AS texts FROM c GROUP BY ALL""")
def workbook_cells(spark, d):
    """Cells of a folder of workbooks by column and kind; the header rows are left to the reader's filter."""
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal", (F.col("c_acctbal") > 0).alias("owed"))
    cells = spark.read.format("workbook").load(_workbooks(spark, c, "customer_book")).where("row > 1")
    text = F.when(F.col("kind") != "number", F.col("text"))
    return cells.groupBy("col", "kind").agg(F.count("*").alias("cells"), F.round(F.coalesce(F.sum("num"), F.lit(0.0)), 2).alias("total"), F.count_distinct(text).alias("texts"))


def _region_trees(spark, d):
    """Regions, nations, customers and orders as trees, one file a region."""
    region, nation, customer, orders = (table(spark, d, n) for n in ("region", "nation", "customer", "orders"))
    form = lambda *kv: F.create_map(*[F.lit(x) if i % 2 == 0 else F.col(x).cast("string") for i, x in enumerate(kv)])
    n = nation.join(region, nation.n_regionkey == region.r_regionkey)
    c = customer.join(n, customer.c_nationkey == n.n_nationkey)
    o = orders.join(c, orders.o_custkey == c.c_custkey)
    columns = lambda path, parent, ord, kind, text, fm: [F.col("r_name").alias("file"), path.alias("path"), parent.alias("parent_path"), F.col(ord).cast("bigint").alias("ord"), F.lit(kind).alias("type"), F.col(text).alias("text"), F.lit(None).cast("string").alias("style"), fm.alias("format")]
    key = lambda letter, name: F.concat(F.lit(letter), F.col(name).cast("string"))
    return (
        region.select(*columns(key("r", "r_regionkey"), F.lit("/"), "r_regionkey", "region", "r_name", form("name", "r_name")))
        .unionByName(n.select(*columns(key("n", "n_nationkey"), key("r", "r_regionkey"), "n_nationkey", "nation", "n_name", form("name", "n_name"))))
        .unionByName(c.select(*columns(key("c", "c_custkey"), key("n", "n_nationkey"), "c_custkey", "customer", "c_name", form("segment", "c_mktsegment", "owed", "c_acctbal"))))
        .unionByName(o.select(*columns(key("o", "o_orderkey"), key("c", "c_custkey"), "o_orderkey", "order", "o_orderpriority", form("status", "o_orderstatus", "price", "o_totalprice"))))
    )


@query("""WITH n AS (SELECT *, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS k FROM nation),
t AS (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY o_orderkey DESC) AS last FROM orders JOIN customer ON o_custkey = c_custkey JOIN n ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT r_name AS file, 'o' || o_orderkey AS path FROM t WHERE c_mktsegment = 'BUILDING' AND o_orderstatus = 'F'
UNION SELECT r_name, 'o' || o_orderkey FROM t WHERE k = 2 AND last = 1
UNION SELECT DISTINCT r_name, 'c' || c_custkey FROM customer JOIN n ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE k = 1 AND c_acctbal < 0""")
def select_in_trees(spark, d):
    """Descendants, children, positions and last ones in a tree a region, by interval labels."""
    trees = selectors.label_nodes(_region_trees(spark, d))
    found = selectors.select_nodes(trees, "region//customer[segment=BUILDING] > order[status=F], /region/nation[2]//order[last()], nation[1] customer[owed<0]")
    return found.select("file", "path")


@query("""WITH n AS (SELECT 'r' || r_regionkey AS id, NULL AS up, r_name AS file, lpad(CAST(r_regionkey AS VARCHAR), 9, '0') AS place, 0 AS depth FROM region
  UNION ALL SELECT 'n' || n_nationkey, NULL, r_name, lpad(CAST(r_regionkey AS VARCHAR), 9, '0') || lpad(CAST(n_nationkey AS VARCHAR), 9, '0'), 1 FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT 'c' || c_custkey, NULL, r_name, lpad(CAST(r_regionkey AS VARCHAR), 9, '0') || lpad(CAST(n_nationkey AS VARCHAR), 9, '0') || lpad(CAST(c_custkey AS VARCHAR), 9, '0'), 2 FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT 'o' || o_orderkey, NULL, r_name, lpad(CAST(r_regionkey AS VARCHAR), 9, '0') || lpad(CAST(n_nationkey AS VARCHAR), 9, '0') || lpad(CAST(c_custkey AS VARCHAR), 9, '0') || lpad(CAST(o_orderkey AS VARCHAR), 9, '0'), 3
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
p AS (SELECT *, row_number() OVER (PARTITION BY file ORDER BY place) - 1 AS pre FROM n),
s AS (SELECT file, substr(place, 1, 9 * unnest(range(1, depth + 2))) AS place FROM p),
z AS (SELECT file, place, count(*) AS size FROM s GROUP BY ALL)
SELECT p.file, id AS path, pre, pre + size - 1 AS post, depth FROM p JOIN z ON p.file = z.file AND p.place = z.place""")
def label_trees(spark, d):
    """Places in document order, ends of subtrees and depths of all nodes."""
    return selectors.label_nodes(_region_trees(spark, d)).select("file", "path", "pre", "post", "depth")


@query("""SELECT p_partkey AS key, CASE WHEN k % 2 = 0 THEN 'cell' ELSE 'row' END AS type, CASE WHEN k % 2 = 0 THEN p_name END AS text FROM (SELECT p_partkey, p_name, unnest([0, 1]) AS k FROM part) WHERE p_partkey % 10 = 3""")
def select_in_sheets(spark, d):
    """Rows and cells of a folder of workbooks by a path with a condition, as trees of sheet, row and cell."""
    cells = spark.read.format("workbook").load(_workbooks(spark, table(spark, d, "part").select("p_partkey", "p_name"), "part_book"))
    nodes = selectors.sheet_nodes(cells)
    hit = selectors.select_nodes(nodes, 'sheet//cell[ord=1][text ~= r"3$"]').select("file", "sheet", F.col("parent_path").alias("p"), F.col("text").cast("bigint").alias("key"))
    both = selectors.select_nodes(nodes, "/sheet > row, row cell[ord=2]")
    at = F.when(F.col("type") == "row", F.col("path")).otherwise(F.col("parent_path"))
    return both.withColumn("p", at).join(hit, ["file", "sheet", "p"]).select("key", "type", "text")


#: A pattern of each kind from the part names, by key: plain, start, end, middle, single characters, escapes, none.
_PATTERN_SQL = """SELECT p_partkey AS k, CASE p_partkey % 8 WHEN 0 THEN upper(p_name) WHEN 1 THEN substr(p_name, 1, 4) || '*' WHEN 2 THEN '*' || right(p_name, 3) WHEN 3 THEN '*' || substr(p_name, 3, 5) || '*'
  WHEN 4 THEN '?' || substr(p_name, 2, 4) || '?*' WHEN 5 THEN '*' || right(p_name, 1) WHEN 6 THEN repeat('?', length(p_name)) ELSE '*~*' || p_name END AS pattern FROM part"""


def _part_patterns(spark, d):
    n, m = F.col("p_name"), F.col("p_partkey") % 8
    kinds = [F.upper(n), F.concat(F.substring(n, 1, 4), F.lit("*")), F.concat(F.lit("*"), F.right(n, F.lit(3))), F.concat(F.lit("*"), F.substring(n, 3, 5), F.lit("*")), F.concat(F.lit("?"), F.substring(n, 2, 4), F.lit("?*")), F.concat(F.lit("*"), F.right(n, F.lit(1))), F.repeat(F.lit("?"), F.char_length(n)), F.concat(F.lit("*~*"), n)]
    pattern = F.when(m == 0, kinds[0])
    for i, kind in enumerate(kinds[1:], 1):
        pattern = pattern.when(m == i, kind)
    return table(spark, d, "part").select(F.col("p_partkey").alias("k"), pattern.alias("pattern"))


_FITS = "lower(p_name) LIKE replace(replace(replace(lower(pattern), '_', '!_'), '?', '_'), '*', '%') ESCAPE '!'"


@query(f"""WITH p AS ({_PATTERN_SQL}), m AS (SELECT k, p_partkey, p_name, row_number() OVER (PARTITION BY k ORDER BY p_partkey) AS r, p_retailprice FROM p JOIN part ON pattern NOT LIKE '*~*%' AND {_FITS})
SELECT p.k, p_partkey AS part, coalesce(p_retailprice, -1) AS price FROM p LEFT JOIN m ON p.k = m.k AND r = 1""")
def lookup_patterns_from_a_table(spark, d):
    """XLOOKUP with wildcards: for a pattern from every part's name the first part that fits."""
    part = table(spark, d, "part").select(F.col("p_partkey").alias("part"), "p_name", F.col("p_retailprice").alias("price"))
    return lookup.xlookup(_part_patterns(spark, d), "pattern", part, "p_name", ["part", "price"], "part", mode=2, default={"price": -1.0}).drop("pattern")


@query(f"""WITH p AS ({_PATTERN_SQL}) SELECT k, count(p_partkey) AS parts, coalesce(round(sum(p_retailprice), 2), 0) AS price FROM p LEFT JOIN part ON pattern NOT LIKE '*~*%' AND {_FITS} GROUP BY k""")
def criteria_patterns_from_a_table(spark, d):
    """COUNTIF and SUMIF with a pattern from every part's name over all parts."""
    part = table(spark, d, "part")
    out = patterns.wildcard_counts(_part_patterns(spark, d), "pattern", part, "p_name", "parts")
    out = patterns.wildcard_counts(out, "pattern", part, "p_name", "price", "p_retailprice")
    return out.select("k", "parts", F.round("price", 2).alias("price"))


@query("""WITH c AS (SELECT c_custkey AS k, c_custkey % 6 AS m FROM customer)
SELECT o_orderstatus, round(sum(o_totalprice), 2) AS dsum, count(*) AS dcount, max(o_totalprice) AS dmax FROM orders WHERE EXISTS (SELECT 1 FROM c WHERE CASE m
  WHEN 0 THEN o_custkey = k AND o_totalprice > 200000 WHEN 1 THEN o_orderpriority LIKE '1%' AND o_custkey = k WHEN 2 THEN o_totalprice > 500000 - k AND o_orderstatus = 'F'
  WHEN 3 THEN o_totalprice < 500 + k AND o_orderkey >= 10 WHEN 4 THEN lower(o_orderpriority) LIKE '_-%e%' AND o_orderkey <= k ELSE o_orderpriority <> '2-HIGH' AND o_orderpriority > '4' AND o_orderkey = 3 * k END) GROUP BY o_orderstatus""")
def database_criteria_from_a_table(spark, d):
    """DSUM, DCOUNT and DMAX of orders with a criteria row for every customer: equalities, ranges, patterns and inequalities."""
    k, m = F.col("c_custkey").cast("string"), F.col("c_custkey") % 6
    cell = lambda *pairs: reduce(lambda a, p: a.when(m == p[0], p[1]), pairs, F.when(F.lit(False), ""))
    rows = table(spark, d, "customer").select(
        cell((0, k), (1, F.concat(F.lit("="), k))).alias("O_CUSTKEY"),
        cell((0, F.lit(">200000")), (2, F.concat(F.lit(">"), (500000 - F.col("c_custkey")).cast("string"))), (3, F.concat(F.lit("<"), (500 + F.col("c_custkey")).cast("string")))).alias("o_totalprice"),
        cell((1, F.lit("1*")), (4, F.lit("?-*E*")), (5, F.lit("<>2-HIGH"))).alias("o_orderpriority"),
        cell((2, F.lit("f"))).alias("o_orderstatus"),
        cell((3, F.lit(">=10")), (4, F.concat(F.lit("<="), k)), (5, (3 * F.col("c_custkey")).cast("string"))).alias("o_orderkey"),
        cell((5, F.lit(">4"))).alias("o_text"),
    )
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", F.concat(F.lit("x"), F.col("o_orderpriority")).alias("o_text"))
    rows = rows.withColumn("o_text", F.when(F.col("o_text").isNotNull(), F.lit(">x4")))
    out = criteria_tables.database_by_table(orders, ["DSUM", "DCOUNT", "DMAX"], "o_totalprice", rows, ["o_orderstatus"])
    return out.select("o_orderstatus", F.round("dsum", 2).alias("dsum"), "dcount", "dmax")


#: A place among sorted values, from 0, mixed of two where it has a fraction.
_AT = "(CASE WHEN {at} BETWEEN 0 AND n - 1 THEN s[CAST(floor({at}) AS BIGINT) + 1] + ({at} - floor({at})) * (s[CAST(ceil({at}) AS BIGINT) + 1] - s[CAST(floor({at}) AS BIGINT) + 1]) END)"
_WANT = {"median": ("median",), "p37": ("percentile", 0.37), "p37_exc": ("percentile_exc", 0.37), "q1": ("quartile", 1), "q1_exc": ("quartile_exc", 1), "q3_exc": ("quartile_exc", 3), "large7": ("large", 7), "small7": ("small", 7), "far": ("large", 10**9)}
_PLACE = {"median": "(n - 1) / 2", "p37": "((n - 1) * 0.37::DOUBLE)", "p37_exc": "(0.37::DOUBLE * (n + 1) - 1)", "q1": "((n - 1) * 0.25::DOUBLE)", "q1_exc": "(0.25::DOUBLE * (n + 1) - 1)", "q3_exc": "(0.75::DOUBLE * (n + 1) - 1)", "large7": "(n - 7)", "small7": "6", "far": "(n - 1000000000)"}


def _order_sql(keys: str, value: str) -> str:
    picked = ", ".join(f"round({_AT.format(at=at)}, 4) AS {name}" for name, at in _PLACE.items())
    return f"SELECT {keys}, n, {picked} FROM (SELECT {keys}, count(v) AS n, list_sort(list(v)) AS s FROM (SELECT {keys}, {value} AS v FROM lineitem) WHERE v IS NOT NULL GROUP BY {keys})"


@query(_order_sql("l_returnflag", "l_extendedprice"))
def order_statistics_of_three_groups(spark, d):
    """LARGE, SMALL, MEDIAN, PERCENTILE and QUARTILE, inclusive and exclusive, of three groups that hold all lines."""
    out = order_statistics(table(spark, d, "lineitem"), ["l_returnflag"], "l_extendedprice", _WANT)
    return out.select("l_returnflag", "n", *[F.round(n, 4).alias(n) for n in _WANT])


@query(_order_sql("l_suppkey, l_linestatus", "CASE WHEN l_linenumber < 6 THEN l_quantity END"))
def order_statistics_of_many_groups(spark, d):
    """The same of thousands of small groups with ties."""
    t = table(spark, d, "lineitem").withColumn("v", F.when(F.col("l_linenumber") < 6, F.col("l_quantity")))
    out = order_statistics(t, ["l_suppkey", "l_linestatus"], "v", _WANT)
    return out.select("l_suppkey", "l_linestatus", "n", *[F.round(n, 4).alias(n) for n in _WANT])


@query("""SELECT l_linestatus, min(v) AS low, max(v) AS high, round(avg(v), 6) AS mean, round(any_value(q1), 4) AS q1, round(any_value(median), 4) AS median, round(any_value(q3), 4) AS q3 FROM (SELECT l_linestatus, l_extendedprice AS v FROM lineitem) JOIN
 (SELECT l_linestatus, """ + ", ".join(f"{_AT.format(at=_PLACE[p])} AS {n}" for n, p in (("q1", "q1_exc"), ("median", "median"), ("q3", "q3_exc"))) + """ FROM (SELECT l_linestatus, count(*) AS n, list_sort(list(l_extendedprice)) AS s FROM lineitem GROUP BY l_linestatus)) USING (l_linestatus) GROUP BY l_linestatus""")
def range_box_exclusive(spark, d):
    out = ranges.box(table(spark, d, "lineitem"), ["l_linestatus"], "l_extendedprice", exclusive=True)
    return out.select("l_linestatus", "low", "high", *[F.round(n, 4).alias(n) for n in ("q1", "median", "q3")], F.round("mean", 6).alias("mean"))


@query("""WITH o AS (SELECT o_orderkey + 1 AS r, o_orderkey % 7 AS m FROM orders)
SELECT CASE m WHEN 1 THEN 'formula_cache_stale' WHEN 2 THEN 'formula_ref_missing_sheet' WHEN 3 THEN 'formula_not_evaluated' WHEN 4 THEN 'formula_eval_error' END AS subtype,
  CASE WHEN m IN (1, 3) THEN 'warning' ELSE 'error' END AS severity, 'L!R' || r || 'C2' AS path FROM o WHERE m BETWEEN 1 AND 4
UNION ALL SELECT CASE n_nationkey % 3 WHEN 1 THEN 'definedname_broken' ELSE 'definedname_target_missing' END, 'error', n_name FROM nation WHERE n_nationkey % 3 > 0""")
def issues_by_references(spark, d):
    """Formulas beside all order values: right and wrong cached running sums, missing sheets, errors and empty caches; names of nations."""
    o = table(spark, d, "orders").select((F.col("o_orderkey") + 1).alias("row"), (F.col("o_orderkey") % 7).alias("m"), F.col("o_totalprice").alias("v"))
    o = scan(o, ["row"], {"upto": Fold("sum", F.col("v"))})
    m, row, none = F.col("m"), F.col("row").cast("string"), F.lit(None).cast("string")
    value = o.select(F.lit(1).cast("bigint").alias("col"), "row", F.lit("number").alias("kind"), F.col("v").alias("num"), F.col("v").cast("string").alias("text"), none.alias("formula"))
    upto = F.concat(F.lit("SUM(A1:$A$"), row, F.lit(")"))
    formula = F.when(m <= 1, upto).when(m == 2, F.lit("'no sheet'!A1+A1")).when(m == 3, F.concat(F.lit("A"), row, F.lit("&\"Gone!A1\""))).when(m == 4, F.lit("1/0")).otherwise(F.concat(F.lit("l!A"), row))
    kind = F.when(m == 3, "blank").when(m == 4, "error").otherwise("number")
    num = F.when(m == 0, F.col("upto")).when(m == 1, F.col("upto") * 2).when(m == 2, 0.0).when(m >= 5, F.col("v"))
    made = o.where("m < 6").select(F.lit(2).cast("bigint").alias("col"), "row", kind.alias("kind"), num.alias("num"), F.when(m == 4, "#DIV/0!").otherwise(num.cast("string")).alias("text"), formula.alias("formula"))
    cells = value.unionByName(made).select(F.lit("f").alias("file"), F.lit("L").alias("sheet"), "row", "col", "kind", "num", "text", "formula")
    nation = table(spark, d, "nation")
    refers = F.when(F.col("n_nationkey") % 3 == 0, "L!$A$1").when(F.col("n_nationkey") % 3 == 1, "L!#REF!").otherwise("Gone!$A$1:$B$2")
    names = nation.select(F.lit("f").alias("file"), F.col("n_name").alias("name"), refers.alias("refers"))
    sheets = table(spark, d, "region").limit(1).select(F.lit("f").alias("file"), F.lit("L").alias("sheet"))
    return references.workbook_issues(cells, sheets, names).select("subtype", "severity", "path")


_LATIN = "regexp_replace(html, '[^\\x01-\\x7E\\x{00A0}-\\x{00FF}]', '?', 'g')"


@query(f"""SELECT page_id, sha256(CASE page_id % 6 WHEN 5 THEN '“' || {_LATIN} || '€”' ELSE {_LATIN} END) AS text FROM pages""")
def import_charsets(spark, d):
    """Pages written in six encodings, by marks, declared charsets and content types, and decoded again."""
    m, text = F.col("page_id") % 6, F.regexp_replace("html", r"[^\x01-\x7E\u00A0-\u00FF]", "?")
    marked = lambda mark, codec: F.concat(F.unhex(F.lit(mark)), F.encode(text, codec))
    windows = F.concat(F.unhex(F.lit("93")), F.encode(text, "ISO-8859-1"), F.unhex(F.lit("8094")))
    data = F.when(m == 0, F.encode(text, "UTF-8")).when(m == 1, marked("EFBBBF", "UTF-8")).when(m == 2, marked("FFFE", "UTF-16LE")).when(m == 3, marked("FEFF", "UTF-16BE")).when(m == 4, F.encode(text, "ISO-8859-1")).otherwise(windows)
    declared = F.when(m == 0, "utf8").when(m == 4, "text/html; charset=Latin1").when(m == 5, "\"windows-1252\"").otherwise("no-such-charset")
    return table(spark, d, "pages").select("page_id", F.sha2(charset.decoded(data, declared), 256).alias("text"))


@query("""SELECT o_orderkey, CAST(k AS BIGINT) AS row, CASE k WHEN 0 THEN o_orderpriority || '|' || o_orderstatus || '; ' ELSE '"' || o_custkey || ' |x y' END AS cells FROM (SELECT *, unnest([0, 1]) AS k FROM orders)""")
def import_grids(spark, d):
    """Grids written in a text, with quotes, blanks and empty rows."""
    o = table(spark, d, "orders")
    text = F.concat(F.lit("  "), F.col("o_orderpriority"), F.lit(' , "'), F.col("o_orderstatus"), F.lit(';" ; ,;"""'), F.col("o_custkey").cast("string"), F.lit('" ,x y ;'))
    rows = charset.grid_rows(o.select("o_orderkey", text.alias("t")), "t", ["o_orderkey"])
    return rows.select("o_orderkey", "row", F.array_join("cells", "|").alias("cells"))


@query("""SELECT '{"success":true,"data":{"key":' || n_nationkey || ',"name":"' || n_name || '"}' || CASE WHEN n_regionkey = 1 THEN ',"warnings":["one"]' ELSE '' END || '}' AS value FROM nation""")
def export_json_lines(spark, d):
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"), "n_regionkey")
    rows = n.withColumn("w", F.when(F.col("n_regionkey") == 1, F.array(F.lit("one"))).otherwise(F.array().cast("array<string>")))
    return charset.json_lines(rows, F.col("w")).select(F.regexp_replace("value", r',"n_regionkey":\d+,"w":\[[^\]]*\]', "").alias("value"))


_TYPO = "CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 1 THEN substr(p_name, 2, 1) || substr(p_name, 1, 1) || substr(p_name, 3) WHEN 2 THEN substr(p_name, 1, 2) || substr(p_name, 4) ELSE upper(p_name) || 'qq' END"


@query(f"""WITH t AS (SELECT p_partkey AS k, lower({_TYPO}) AS w FROM part), n AS (SELECT DISTINCT lower(p_name) AS n FROM part),
m AS (SELECT k, n, damerau_levenshtein(w, n) AS d, row_number() OVER (PARTITION BY k ORDER BY damerau_levenshtein(w, n), n) AS r FROM t JOIN n ON abs(length(w) - length(n)) <= 2 AND damerau_levenshtein(w, n) <= 2)
SELECT t.k, n AS meant, d AS distance FROM t LEFT JOIN m ON t.k = m.k AND r = 1""")
def lookup_did_you_mean(spark, d):
    """The nearest part name, by edits and transpositions, of a misspelt one from every part."""
    n, m = F.col("p_name"), F.col("p_partkey") % 4
    typo = F.when(m == 0, n).when(m == 1, F.concat(F.substring(n, 2, 1), F.substring(n, 1, 1), F.substring(n, 3, 999))).when(m == 2, F.concat(F.substring(n, 1, 2), F.substring(n, 4, 999))).otherwise(F.concat(F.upper(n), F.lit("qq")))
    part = table(spark, d, "part")
    words = part.select(F.col("p_partkey").alias("k"), typo.alias("w"))
    return spelling.nearest_words(words, "w", part, "p_name", most=2, name="meant").select("k", "meant", "distance")


@query("""WITH o AS (SELECT o_custkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS BIGINT) AS r FROM orders), n AS (SELECT o_custkey, max(r) AS n FROM o GROUP BY 1)
SELECT o_custkey AS sheet, CAST(2 AS BIGINT) AS first_row, CAST(2 AS BIGINT) AS first_col, CAST(3 AS BIGINT) AS columns, least(n, 5) AS rows, 'order,price,2024' AS header FROM n
UNION ALL SELECT o_custkey, 9, 3, 2, n - 5, 'price,2024' FROM n WHERE n > 5""")
def detect_tables_in_sheets(spark, d):
    """A sheet for each customer with its orders: one table of up to five rows, and below a blank row another one without the first column."""
    place = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")).cast("bigint")
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("sheet"), "o_orderkey", "o_totalprice", place.alias("r"))
    lower = F.col("r") > 5
    at = F.when(lower, F.col("r") + 4).otherwise(F.col("r") + 2)
    cell = lambda row, col, text: F.struct(row.cast("bigint").alias("row"), F.lit(col).cast("bigint").alias("col"), text.cast("string").alias("text"))
    body = o.select("sheet", F.explode(F.array(cell(at, 2, F.when(~lower, F.col("o_orderkey"))), cell(at, 3, F.when(F.col("r") % 3 != 0, F.col("o_totalprice"))), cell(at, 4, F.when((F.col("r") % 3 == 0) | lower, F.lit("x"))))).alias("c"))
    head = lambda row, names: F.array(*[cell(F.lit(row), 2 + i, F.lit(n)) for i, n in enumerate(names)])
    heads = o.where("r IN (1, 6)").select("sheet", F.explode(F.when(lower, head(9, [None, "price", "2024"])).otherwise(head(2, ["order", "price", "2024"]))).alias("c"))
    found = table_finder.detect_tables(body.unionByName(heads).select("sheet", "c.*"))
    return found.withColumn("header", F.array_join("header", ","))


@query("""WITH s AS (SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'gone' WHEN 1 THEN 'set' WHEN 2 THEN 'new' WHEN 3 THEN 'back' ELSE 'kept' END AS how, * FROM customer)
SELECT c_custkey, CASE how WHEN 'new' THEN 'n' || c_name WHEN 'back' THEN NULL ELSE c_name END AS c_name, CASE how WHEN 'set' THEN c_acctbal + 1 WHEN 'back' THEN 5.0 ELSE c_acctbal END AS c_acctbal FROM s WHERE how <> 'gone'
UNION ALL SELECT -1 - c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey % 5 = 4""")
def batch_dump_and_replay(spark, d):
    """Customers dumped to steps; edits of four kinds appended; the log replayed over the table."""
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    keys, m, none = ["c_custkey"], F.col("c_custkey") % 5, F.lit(None)
    step = lambda where, seq, op, key, name, balance: c.where(where).select(F.lit(seq).alias("seq"), F.to_json(F.struct(F.lit(op).alias("op"), F.struct(key.alias("c_custkey")).alias("key"), F.struct(name.cast("string").alias("c_name"), balance.cast("double").alias("c_acctbal")).alias("values"))).alias("step"))
    k, name, balance = F.col("c_custkey"), F.col("c_name"), F.col("c_acctbal")
    log = batches.dump_rows(c.where(m == 4).withColumn("c_custkey", -1 - k), keys).select(F.lit(1).alias("seq"), "step")
    edits = [
        step(m == 0, 1, "set", k, F.lit("x"), none), step(m == 0, 2, "remove", k, none, none), step(m == 0, 3, "set", k, F.lit("y"), none), step(m == 1, 1, "set", k, none, balance), step(m == 1, 2, "set", k, none, balance + 1),
        step(m == 2, 1, "set", k, none, F.lit(0)), step(m == 2, 2, "add", k, F.concat(F.lit("n"), name), balance), step(m == 3, 1, "remove", k, none, none), step(m == 3, 2, "add", k, none, F.lit(4)), step(m == 3, 3, "set", k, none, F.lit(5)),
    ]
    log = reduce(lambda a, b: a.unionByName(b), edits, log)
    steps = batches.parsed_steps(log, "c_custkey bigint, c_name string, c_acctbal double", keys, "seq")
    return batches.replay(c, steps, keys, "seq")


@query("""SELECT 'orders' AS name, count(*) AS rows, 3 AS columns, count(*) FILTER (WHERE o_orderkey % 4 = 0) AS formulas FROM orders""")
def profile_outline(spark, d):
    o = table(spark, d, "orders")
    cell = F.when(F.col("o_orderkey") % 4 == 0, F.concat(F.lit("=A"), F.col("o_orderkey"))).otherwise(F.col("o_comment") if "o_comment" in o.columns else F.lit("text"))
    return profile.outline(o.select("o_orderkey", "o_orderstatus", cell.alias("cell")), "orders")


@query("""SELECT conv_id, turn, 'node' AS part, 'A' AS source, role AS target, NULL AS label FROM conversations UNION ALL SELECT conv_id, turn, 'node', 'B', 'T' || turn, NULL FROM conversations
UNION ALL SELECT conv_id, turn, 'edge', 'A', 'B', 'says' FROM conversations""")
def diagram_of_turns(spark, d):
    """Nodes and edges of a small diagram around every turn."""
    t = table(spark, d, "conversations")
    text = F.concat(F.lit("graph TD\nA["), F.col("role"), F.lit("] -->|says| B(T"), F.col("turn"), F.lit(")\n"))
    parts = markup.diagram_parts(t.select("conv_id", "turn", text.alias("g")), "g", ["conv_id", "turn"])
    return parts.withColumn("label", F.when(F.col("part") == "edge", F.col("label")))
