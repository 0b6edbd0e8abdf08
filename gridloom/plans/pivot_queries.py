"""Pivots over orders and order lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.operators.pivot import Pivot
from gridloom.plans.registry import query
from gridloom.plans.tables import SALES_SQL, sales, table


def _round(df, names, digits=4):
    for n in names:
        df = df.withColumn(n, F.round(n, digits))
    return df


@query(f"""SELECT r_name, n_name, CAST(GROUPING(r_name) + GROUPING(n_name) AS INT) AS row_level, 0 AS col_level,
  round(sum(l_extendedprice), 2) AS sales, count(l_quantity) AS lines, round(avg(l_discount), 6) AS discount
FROM {SALES_SQL} GROUP BY ROLLUP (r_name, n_name)""")
def pivot_sales_by_region(spark, d):
    p = Pivot(["r_name", "n_name"], values=["l_extendedprice:sum::sales", "l_quantity:count::lines", "l_discount:average::discount"])
    out = p.build(sales(spark, d))
    return out.withColumn("sales", F.round("sales", 2)).withColumn("discount", F.round("discount", 6))


@query("""SELECT o_orderpriority, o_orderstatus, CAST(GROUPING(o_orderpriority) AS INT) AS row_level, CAST(GROUPING(o_orderstatus) AS INT) AS col_level,
  round(sum(o_totalprice), 2) AS total, count(o_totalprice) AS n FROM orders GROUP BY CUBE (o_orderpriority, o_orderstatus)""")
def pivot_two_axes(spark, d):
    p = Pivot(["o_orderpriority"], ["o_orderstatus"], ["o_totalprice:sum::total", "o_totalprice:count::n"])
    return _round(p.build(table(spark, d, "orders")), ["total"], 2)


_SHARES = """WITH g AS (SELECT o_orderpriority, o_orderstatus, GROUPING(o_orderpriority) AS rl, GROUPING(o_orderstatus) AS cl, sum(o_totalprice) AS s
  FROM orders GROUP BY CUBE (o_orderpriority, o_orderstatus))
SELECT o_orderpriority, o_orderstatus, CAST(rl AS INT) AS row_level, CAST(cl AS INT) AS col_level,
  round(s / max(s) FILTER (WHERE rl = 1 AND cl = 1) OVER (), 8) AS of_total,
  round(s / max(s) FILTER (WHERE cl = 1) OVER (PARTITION BY o_orderpriority, rl), 8) AS of_row,
  round(s / max(s) FILTER (WHERE rl = 1) OVER (PARTITION BY o_orderstatus, cl), 8) AS of_col,
  round(CASE WHEN cl = 0 THEN sum(s) OVER (PARTITION BY o_orderpriority, rl, cl ORDER BY o_orderstatus ROWS UNBOUNDED PRECEDING) ELSE s END, 2) AS running
FROM g"""


@query(_SHARES)
def pivot_show_as(spark, d):
    shows = {"of_total": "percent_of_total", "of_row": "percent_of_row", "of_col": "percent_of_col", "running": "running_total"}
    p = Pivot(["o_orderpriority"], ["o_orderstatus"], [f"o_totalprice:sum:{s}:{n}" for n, s in shows.items()])
    out = _round(p.build(table(spark, d, "orders")), ["of_total", "of_row", "of_col"], 8)
    return _round(out, ["running"], 2)


@query("""WITH o AS (SELECT *, CAST(year(o_orderdate) AS VARCHAR) AS y, 'Qtr' || quarter(o_orderdate) AS q FROM orders)
SELECT y AS o_orderdate_year, q AS o_orderdate_quarter, CAST(GROUPING(y) + GROUPING(q) AS INT) AS row_level, 0 AS col_level,
  round(sum(o_totalprice), 2) AS total, round(coalesce(stddev_samp(o_totalprice), 0), 4) AS spread FROM o GROUP BY ROLLUP (y, q)""")
def pivot_date_groups(spark, d):
    p = Pivot(["o_orderdate:year", "o_orderdate:quarter"], values=["o_totalprice:sum::total", "o_totalprice:stdDev::spread"])
    return _round(_round(p.build(table(spark, d, "orders")), ["total"], 2), ["spread"], 4)


@query(f"""WITH s AS (SELECT * FROM {SALES_SQL} WHERE l_returnflag IN ('A', 'R')),
 top AS (SELECT n_name FROM s GROUP BY n_name ORDER BY sum(l_quantity) DESC, n_name LIMIT 7)
SELECT n_name, c_mktsegment, CAST(GROUPING(n_name) + GROUPING(c_mktsegment) AS INT) AS row_level, 0 AS col_level, sum(l_quantity) AS quantity
FROM s WHERE n_name IN (SELECT n_name FROM top) AND NOT contains(n_name, '1') GROUP BY ROLLUP (n_name, c_mktsegment)""")
def pivot_top_and_filters(spark, d):
    p = Pivot(["n_name", "c_mktsegment"], values=["l_quantity:sum::quantity"], filters={"l_returnflag": ["A", "R"]}, top_n=7, label_filter=("n_name", "doesNotContain", "1"))
    return p.build(sales(spark, d))


@query("""SELECT l_returnflag, l_linestatus, round(sum(l_tax), 4) AS s, count(l_tax) AS n, round(avg(l_tax), 8) AS a, min(l_tax) AS lo, max(l_tax) AS hi,
  round(stddev_samp(l_tax), 8) AS sd, round(stddev_pop(l_tax), 8) AS sdp, round(var_samp(l_tax), 8) AS v, round(var_pop(l_tax), 8) AS vp,
  0 AS row_level, 0 AS col_level FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def pivot_all_aggregates(spark, d):
    how = {"s": "sum", "n": "count", "a": "average", "lo": "min", "hi": "max", "sd": "stdDev", "sdp": "stdDevp", "v": "var", "vp": "varp"}
    p = Pivot(["l_returnflag", "l_linestatus"], values=[f"l_tax:{h}::{n}" for n, h in how.items()], subtotals=False, grand_totals="none")
    return _round(_round(p.build(table(spark, d, "lineitem")), ["s"], 4), ["a", "sd", "sdp", "v", "vp"], 8)


@query("""SELECT o_orderpriority, 0 AS row_level, round(coalesce(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'F'), NULL), 2) AS F,
  round(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'O'), 2) AS O, round(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'P'), 2) AS P
FROM orders GROUP BY o_orderpriority
UNION ALL SELECT NULL, 1, round(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'F'), 2), round(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'O'), 2),
  round(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'P'), 2) FROM orders""")
def pivot_wide(spark, d):
    p = Pivot(["o_orderpriority"], ["o_orderstatus"], ["o_totalprice:sum::total"])
    return _round(p.wide(table(spark, d, "orders"), ["F", "O", "P"]), ["F", "O", "P"], 2)


@query("""SELECT l_shipmode, 0 AS row_level, 0 AS col_level, round(s, 2) AS s, round(q, 2) AS q, round(s / q, 6) AS unit FROM (
  SELECT l_returnflag AS l_shipmode, sum(l_extendedprice) AS s, sum(l_quantity) AS q FROM lineitem GROUP BY ALL)""")
def pivot_calculated_field(spark, d):
    """Calculated fields work on the sums, not on the rows."""
    df = table(spark, d, "lineitem").withColumnRenamed("l_returnflag", "l_shipmode")
    p = Pivot(["l_shipmode"], values=["l_extendedprice:sum::s", "l_quantity:sum::q"], grand_totals="none", calculated={"unit": "round(s / q, 6)"})
    return _round(p.build(df), ["s", "q"], 2)
