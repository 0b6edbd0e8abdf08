"""Pivot tables: groups over row and column fields with subtotals, totals, top-N, filters and show-as.

The plan follows the order of the steps: page filters, date groups, rows without an axis key leave, top-N,
label filter, grouping sets, show-as. Totals aggregate source rows anew, so they are right for every
aggregate. Cells come in long form; ``wide`` spreads the column fields.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridloom.functions.ordered import Fold, scan

_NUM = lambda x: x.try_cast("double")

AGGREGATES = {
    "sum": lambda x: F.coalesce(F.sum(_NUM(x)), F.lit(0.0)),
    "count": lambda x: F.count(_NUM(x)),
    "countNums": lambda x: F.count(_NUM(x)),
    "average": lambda x: F.coalesce(F.avg(_NUM(x)), F.lit(0.0)),
    "min": lambda x: F.coalesce(F.min(_NUM(x)), F.lit(0.0)),
    "max": lambda x: F.coalesce(F.max(_NUM(x)), F.lit(0.0)),
    "product": lambda x: F.coalesce(F.product(_NUM(x)), F.lit(0.0)),
    "stdDev": lambda x: F.coalesce(F.stddev_samp(_NUM(x)), F.lit(0.0)),
    "stdDevp": lambda x: F.coalesce(F.stddev_pop(_NUM(x)), F.lit(0.0)),
    "var": lambda x: F.coalesce(F.var_samp(_NUM(x)), F.lit(0.0)),
    "varp": lambda x: F.coalesce(F.var_pop(_NUM(x)), F.lit(0.0)),
}
#: Parts that each cell keeps, and the aggregates that totals can be made of them; x is the prefix of their names.
_PARTS = {"sum": lambda x: F.sum(_NUM(x)), "count": lambda x: F.count(_NUM(x)), "min": lambda x: F.min(_NUM(x)), "max": lambda x: F.max(_NUM(x)), "product": lambda x: F.product(_NUM(x))}
_part = lambda x, name: F.col(f"{x}_{name}")
_MERGED = {
    "sum": lambda x: F.coalesce(F.sum(_part(x, "sum")), F.lit(0.0)),
    "count": lambda x: F.coalesce(F.sum(_part(x, "count")), F.lit(0)),
    "countNums": lambda x: F.coalesce(F.sum(_part(x, "count")), F.lit(0)),
    "average": lambda x: F.coalesce(F.try_divide(F.sum(_part(x, "sum")), F.sum(_part(x, "count"))), F.lit(0.0)),
    "min": lambda x: F.coalesce(F.min(_part(x, "min")), F.lit(0.0)),
    "max": lambda x: F.coalesce(F.max(_part(x, "max")), F.lit(0.0)),
    "product": lambda x: F.coalesce(F.product(_part(x, "product")), F.lit(0.0)),
}
_TITLES = {"sum": "Sum", "count": "Count", "countNums": "Count", "average": "Average", "min": "Min", "max": "Max", "product": "Product", "stdDev": "StdDev", "stdDevp": "StdDevp", "var": "Var", "varp": "Varp"}
SHOW_AS = ("percent_of_total", "percent_of_row", "percent_of_col", "running_total")


@dataclass(frozen=True)
class Value:
    """A value field: what is aggregated, how, how it is shown and what it is called."""

    field: str
    how: str = "sum"
    show_as: str | None = None
    name: str | None = None

    @staticmethod
    def parse(text: str) -> Value:
        """``Field[:aggregate[:show-as[:name]]]``; a field may hold colons, so known words are sought from the right."""
        parts = text.split(":")
        for i in range(1, len(parts)):
            how = "average" if parts[i] == "avg" else parts[i]
            if how in AGGREGATES:
                rest = parts[i + 1 :]
                show = rest[0] if rest and rest[0] else None
                if show in ("normal", None):
                    show = None
                elif show not in SHOW_AS:
                    raise ValueError(f"show-as {show!r} is not supported; use one of {', '.join(SHOW_AS)}")
                return Value(":".join(parts[:i]), how, show, ":".join(rest[1:]) or None)
        return Value(text)

    @property
    def alias(self) -> str:
        return self.name or f"{_TITLES[self.how]} of {self.field}"


_DATE_GROUPS = {
    "year": lambda d: F.year(d).cast("string"),
    "quarter": lambda d: F.concat(F.lit("Qtr"), F.quarter(d).cast("string")),
    "month": lambda d: F.date_format(d, "MMM"),
    "day": lambda d: F.dayofmonth(d).cast("string"),
}
LABEL_TESTS = {
    "contains": lambda x, v: x.contains(v),
    "doesNotContain": lambda x, v: ~x.contains(v),
    "beginsWith": lambda x, v: x.startswith(v),
    "endsWith": lambda x, v: x.endswith(v),
    "equals": lambda x, v: x == v,
    "notEquals": lambda x, v: x != v,
}


@dataclass
class Pivot:
    """A pivot's specification; ``build`` gives its plan for a DataFrame."""

    rows: list[str]
    cols: list[str] = field(default_factory=list)
    values: list[Value | str] = field(default_factory=list)
    filters: dict[str, list] = field(default_factory=dict)
    top_n: int | None = None
    label_filter: tuple[str, str, str] | None = None
    subtotals: bool = True
    grand_totals: str = "both"
    calculated: dict[str, str] = field(default_factory=dict)

    def build(self, df: DataFrame) -> DataFrame:
        """Long form: the axis fields (NULL where a row is a total over them), row_level, col_level, values.

        A level is the number of axis fields that a row is totalled over: 0 for a cell. Calculated fields are
        SQL expressions over the value names, evaluated after aggregation.
        """
        values = [v if isinstance(v, Value) else Value.parse(v) for v in self.values]
        axes = {a: a.replace(":", "_") for a in [*self.rows, *self.cols]}
        for name, allowed in self.filters.items():
            df = df.where(F.col(name).isin(allowed))
        labels = {}
        for axis, name in axes.items():
            source, _, group = axis.rpartition(":")
            labels[name] = _DATE_GROUPS[group](F.col(source)) if group in _DATE_GROUPS and source else F.col(axis)
        used = list(dict.fromkeys(v.field for v in values))
        df = df.select(*[x.alias(n) for n, x in labels.items()], *[F.col(u).alias(f"__v{i}") for i, u in enumerate(used)])
        for name in labels:
            df = df.where(F.col(name).isNotNull() & (F.col(name).cast("string") != ""))
        where = {u: f"__v{i}" for i, u in enumerate(used)}
        measure = lambda v: AGGREGATES[v.how](F.col(where[v.field]))
        if labels and all(v.how in _MERGED for v in values):
            # totals are merged from the cells' parts, so source rows are aggregated once and never multiplied
            df = df.groupBy(*labels).agg(*[f(F.col(x)).alias(f"{x}_{name}") for x in where.values() for name, f in _PARTS.items()])
            measure = lambda v: _MERGED[v.how](where[v.field])
        if self.top_n:
            df = self._top(df, axes[self.rows[0]], measure(values[0]))
        if self.label_filter:
            name, test, value = self.label_filter
            df = df.where(LABEL_TESTS[test](F.col(axes[name]).cast("string"), value))
        r, c = [axes[x] for x in self.rows], [axes[x] for x in self.cols]
        sets = [[*r[:i], *c[:j]] for i in self._depths(r, "rows") for j in self._depths(c, "cols")]
        totals = [F.grouping(x).cast("int") for x in (*r, *c)]
        aggregates = [measure(v).alias(v.alias) for v in values]
        out = df.groupingSets([[F.col(x) for x in s] for s in sets], *[F.col(x) for x in (*r, *c)]).agg(
            sum(totals[: len(r)], F.lit(0)).alias("row_level"), sum(totals[len(r) :], F.lit(0)).alias("col_level"), *aggregates
        )
        for v in values:
            if v.show_as:
                out = self._shown(out, v, r, c)
        for name, formula in self.calculated.items():
            out = out.withColumn(name, F.expr(formula))
        return out

    def _depths(self, axis: list[str], which: str) -> list[int]:
        """How many leading fields the grouping sets keep: all, those of subtotals, none for grand totals."""
        grand = self.grand_totals in ("both", "rows" if which == "cols" else "cols") or not axis
        inner = range(1, len(axis)) if self.subtotals else []
        return [*([len(axis)] if axis else []), *reversed(inner), *([0] if grand else [])]

    def _top(self, df: DataFrame, first: str, measure: Column) -> DataFrame:
        """The outermost keys of greatest first value; ties go by label. Limited before it is joined back."""
        best = df.groupBy(first).agg(measure.alias("__t")).orderBy(F.desc("__t"), F.col(first)).limit(self.top_n)
        return df.join(F.broadcast(best.select(first)), first, "left_semi")  # top_n rows

    def _shown(self, out: DataFrame, v: Value, r: list[str], c: list[str]) -> DataFrame:
        """Shares of totals over the result's own total rows, so any aggregate has its right total."""
        x = F.col(f"`{v.alias}`")
        if v.show_as == "running_total":
            if c:
                w = Window.partitionBy(*r, "row_level", "col_level").orderBy(*c).rowsBetween(Window.unboundedPreceding, 0)
                return out.withColumn(v.alias, F.when(F.col("col_level") == 0, F.sum(x).over(w)).otherwise(x))
            run = scan(out, r, {"__run": Fold("sum", x)}, ["row_level"])
            return run.withColumn(v.alias, F.when(F.col("row_level") == 0, F.col("__run")).otherwise(x)).drop("__run")
        top_r, top_c = F.col("row_level") == len(r), F.col("col_level") == len(c)
        if v.show_as == "percent_of_total":
            whole = out.where(top_r & top_c).agg(F.max(x).alias("__whole"))  # the one grand total
            joined = out.crossJoin(F.broadcast(whole))
            return joined.withColumn(v.alias, F.try_divide(x, F.col("__whole"))).drop("__whole")
        elif v.show_as == "percent_of_row":
            total = F.max(F.when(top_c, x)).over(Window.partitionBy(*r, "row_level"))
        else:
            total = F.max(F.when(top_r, x)).over(Window.partitionBy(*c, "col_level"))
        return out.withColumn(v.alias, F.try_divide(x, total))

    def wide(self, df: DataFrame, keys: list) -> DataFrame:
        """Cells and row totals with one column for each of ``keys`` of the (only) column field, and for each value."""
        values = [v if isinstance(v, Value) else Value.parse(v) for v in self.values]
        r, col = [x.replace(":", "_") for x in self.rows], self.cols[0].replace(":", "_")
        long = self.build(df).where("col_level = 0")
        return long.groupBy(*r, "row_level").pivot(col, keys).agg(*[F.first(F.col(f"`{v.alias}`")).alias(v.alias) for v in values])


def ordered(out: DataFrame, pivot: Pivot, descending: bool = False, collation: str | None = None, totals_first: bool = False) -> DataFrame:
    """Presentation order: labels by axis, each total after (or before) its children; a collation sorts by locale."""
    keys = []
    for name in [x.replace(":", "_") for x in (*pivot.rows, *pivot.cols)]:
        x = F.col(name)
        keys.append(x.isNull().asc() if not totals_first else x.isNull().desc())
        x = F.collate(x, collation) if collation else x
        keys.append(x.desc() if descending else x.asc())
    return out.orderBy(*keys)
