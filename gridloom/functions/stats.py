"""Descriptive statistics, ranks, quantiles and regression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from gridloom.functions.arrays import sum_before
from gridloom.functions.base import c, fn, num, ok
from gridloom.functions.order_stats import null_safe_join, order_statistics
from gridloom.functions.ordered import Fold, scan
from gridloom.staging import staged

fn("MEDIAN")(lambda x: F.median(num(x)))
fn("STDEV", "STDEV.S")(lambda x: F.stddev_samp(num(x)))
fn("STDEVP", "STDEV.P")(lambda x: F.stddev_pop(num(x)))
fn("VAR", "VAR.S")(lambda x: F.var_samp(num(x)))
fn("VARP", "VAR.P")(lambda x: F.var_pop(num(x)))
fn("GEOMEAN")(lambda x: F.when(F.min(num(x)) > 0, F.exp(F.avg(F.ln(num(x))))))
fn("HARMEAN")(lambda x: F.when(F.min(num(x)) > 0, F.count(num(x)) / F.sum(F.try_divide(F.lit(1.0), num(x)))))
fn("DEVSQ")(lambda x: F.var_pop(num(x)) * F.count(num(x)))
fn("SKEW.P")(lambda x: F.skewness(num(x)))
fn("CORREL", "PEARSON")(lambda x, y: F.corr(num(x), num(y)))
fn("COVARIANCE.P", "COVAR")(lambda x, y: F.covar_pop(num(x), num(y)))
fn("COVARIANCE.S")(lambda x, y: F.covar_samp(num(x), num(y)))
fn("SLOPE")(lambda y, x: F.regr_slope(num(y), num(x)))
fn("INTERCEPT")(lambda y, x: F.regr_intercept(num(y), num(x)))
fn("RSQ")(lambda y, x: F.regr_r2(num(y), num(x)))
fn("FORECAST", "FORECAST.LINEAR")(lambda at, y, x: F.regr_intercept(num(y), num(x)) + F.regr_slope(num(y), num(x)) * num(at))
fn("PROB")(lambda x, p, lo, hi=None: F.sum(F.when(num(x).between(num(lo), num(lo if hi is None else hi)), num(p)).otherwise(0.0)))
fn("STANDARDIZE")(lambda x, mean, sd: ok(num(sd) > 0, F.try_divide(num(x) - num(mean), num(sd))))


def typed(x: Column, of: str) -> Column:
    """Values of a text column for the A-functions: numbers as they are, TRUE 1, other text 0."""
    if of != "string":
        return num(x)
    s = F.upper(F.trim(x))
    return F.when(s == "TRUE", F.lit(1.0)).otherwise(F.when(x.isNotNull(), F.coalesce(x.try_cast("double"), F.lit(0.0))))


fn("AVERAGEA")(lambda x, of="string": F.avg(typed(c(x), of)))
fn("MAXA")(lambda x, of="string": F.coalesce(F.max(typed(c(x), of)), F.lit(0.0)))
fn("MINA")(lambda x, of="string": F.coalesce(F.min(typed(c(x), of)), F.lit(0.0)))


@fn("SKEW")
def skew(x) -> Column:
    n = F.count(num(x))
    return F.when(n > 2, F.skewness(num(x)) * F.sqrt(n * (n - 1)) / (n - 2))


@fn("KURT")
def kurt(x) -> Column:
    n = F.count(num(x))
    return F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(num(x)) + 6))


@fn("STEYX")
def steyx(y, x) -> Column:
    y, x = num(y), num(x)
    rest = F.regr_syy(y, x) - F.try_divide(F.regr_sxy(y, x) * F.regr_sxy(y, x), F.regr_sxx(y, x))
    return F.when(F.regr_count(y, x) > 2, F.sqrt(F.try_divide(rest, F.regr_count(y, x) - 2)))


fn("PERCENTILE", "PERCENTILE.INC")(lambda x, k: F.percentile(num(x), k))
fn("QUARTILE", "QUARTILE.INC")(lambda x, q: F.percentile(num(x), q / 4))


@fn("PERCENTILE.EXC")
def percentile_exc(x, k: float) -> Column:
    """At k(n + 1) - 1 of the sorted values; interpolated between two inclusive percentiles."""
    n = F.count(num(x))
    at = F.lit(k) * (n + 1) - 1
    values = F.array_sort(F.collect_list(num(x)))
    low = F.get(values, F.floor(at).cast("int"))
    high = F.get(values, F.ceil(at).cast("int"))
    return F.when((at >= 0) & (at <= n - 1), low + (high - low) * (at - F.floor(at)))


fn("QUARTILE.EXC")(lambda x, q: percentile_exc(x, q / 4))
# Of small groups; ``kth`` and ``order_stats.order_statistics`` take groups of any size.
fn("LARGE")(lambda x, k: F.get(F.sort_array(F.collect_list(num(x)), asc=False), F.lit(int(k) - 1)))
fn("SMALL")(lambda x, k: F.get(F.sort_array(F.collect_list(num(x))), F.lit(int(k) - 1)))


def kth(df: DataFrame, keys: list[str], value: str, k: int, largest: bool = True) -> DataFrame:
    """LARGE or SMALL of each group without gathering the group: keys and the k-th value; groups of fewer values have none."""
    found = order_statistics(df, keys, value, {"__k": ("large" if largest else "small", k)})
    return found.where(F.col("__k").isNotNull()).select(*keys, F.col("__k").cast(df.schema[value].dataType).alias(value))


def _ordered(x: Column, ascending: bool, keys: list) -> WindowSpec:
    if not keys:
        raise ValueError("ranks among all rows come from ranks(df, value): a window without keys is one task")
    return Window.partitionBy(*keys).orderBy(x.asc() if ascending else x.desc())


@fn("RANK", "RANK.EQ")
def rank_eq(x, ascending: bool = False, keys: list | None = None) -> Column:
    """Competition rank of each row within its keys; ``ranks`` ranks all rows of a table."""
    return F.rank().over(_ordered(num(x), ascending, keys or []))


def ranks(df: DataFrame, value: str, ascending: bool = False) -> DataFrame:
    """``df`` with ``rank_eq`` and ``rank_avg`` among all rows, NULL for NULL: values are counted, the counts
    summed up stretch by stretch, and the ranks joined back, so that no task sorts all rows."""
    counted = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("__n"))
    placed = sum_before(counted, value, "__n", descending=not ascending, name="__b")
    first = (F.col("__b") + 1).cast("bigint")
    return df.join(placed.select(value, first.alias("rank_eq"), (first + (F.col("__n") - 1) / 2).alias("rank_avg")), value, "left")


@fn("RANK.AVG")
def rank_avg(x, ascending: bool = False, keys: list | None = None) -> Column:
    ties = F.count("*").over(Window.partitionBy(*(keys or []), num(x)))
    return rank_eq(x, ascending, keys) + (ties - 1) / 2


@fn("PERCENTRANK", "PERCENTRANK.INC")
def percent_rank(x, digits: int = 3, keys: list | None = None) -> Column:
    """Fraction of smaller values, cut (not rounded) to ``digits``."""
    p = F.percent_rank().over(_ordered(num(x), True, keys or []))
    return F.floor(p * 10**digits + 1e-9) / 10**digits


def modes(df: DataFrame, value: str, order: str, keys: list[str] | None = None) -> DataFrame:
    """MODE.MULT: keys, value and how often, of the values met most and more than once; ``first`` orders them."""
    keys = keys or []
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"), F.min(order).alias("first"))
    top = F.rank().over(Window.partitionBy(*keys).orderBy(F.desc("n")))
    return counted.withColumn("__r", top).where("__r = 1 AND n > 1").drop("__r")


def mode_single(df: DataFrame, value: str, order: str, keys: list[str] | None = None) -> DataFrame:
    """MODE.SNGL: of tied values the one seen first."""
    keys = keys or []
    first = F.row_number().over(Window.partitionBy(*keys).orderBy("first"))
    return modes(df, value, order, keys).withColumn("__r", first).where("__r = 1").select(*keys, value, "n")


def average_deviation(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """AVEDEV in two passes: the mean joined back by a window, then the mean distance from it."""
    mean = F.avg(value).over(Window.partitionBy(*keys))
    return df.withColumn("__d", F.abs(F.col(value) - mean)).groupBy(*keys).agg(F.avg("__d").alias("avedev"))


def trimmed_mean(df: DataFrame, keys: list[str], value: str, share: float) -> DataFrame:
    """TRIMMEAN: floor(n * share / 2) values are left out at each end.

    Values are counted, and a value that the cut runs through counts for the rows that stay.
    """
    counted = staged(df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("__n")), "counted")
    ranked = scan(counted, [value], {"__upto": Fold("sum", F.col("__n"))}, keys)
    total = counted.groupBy(*keys).agg(F.sum("__n").alias("__all"))
    joined = null_safe_join(ranked, total, keys)
    cut = F.floor(F.col("__all") * share / 2)
    kept = F.greatest(F.least(F.col("__upto"), F.col("__all") - cut) - F.greatest(F.col("__upto") - F.col("__n"), cut), F.lit(0))
    return joined.groupBy(*keys).agg(F.try_divide(F.sum(F.col(value) * kept), F.sum(kept)).alias("trimmean"))


def linear_fit(df: DataFrame, keys: list[str], y: str, xs: list[str], intercept: bool = True, logs: bool = False) -> DataFrame:
    """LINEST (with ``logs`` LOGEST): one row a group with the coefficients and their statistics.

    Sums of products are aggregated by Spark; each group's small normal equations are solved in a batch.
    Coefficients stand in the order of ``xs``, then the intercept.
    """
    import numpy as np
    import pandas as pd

    names = [*xs, "intercept"] if intercept else list(xs)
    row = [F.col(x).cast("double") for x in xs] + ([F.lit(1.0)] if intercept else [])
    target = F.ln(F.col(y)) if logs else F.col(y).cast("double")
    sums = [F.sum(a * b).alias(f"s{i}_{j}") for i, a in enumerate(row) for j, b in enumerate(row) if j >= i]
    sums += [F.sum(a * target).alias(f"t{i}") for i, a in enumerate(row)]
    sums += [F.sum(target * target).alias("yy"), F.sum(target).alias("ysum"), F.count("*").alias("n")]
    sound = F.col(y).isNotNull()
    for x in xs:
        sound = sound & F.col(x).isNotNull()
    if logs:
        sound = sound & (F.col(y) > 0)
    grouped = df.where(sound).groupBy(*keys).agg(*sums)
    k = len(row)

    def solve(batches):
        for b in batches:
            out = []
            for r in b.to_dict("records"):
                a = np.array([[r[f"s{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)])
                t = np.array([r[f"t{i}"] for i in range(k)])
                beta = np.linalg.lstsq(a, t, rcond=None)[0]
                rest = max(r["yy"] - float(beta @ t), 0.0)
                spread = r["yy"] - (r["ysum"] ** 2 / r["n"] if intercept else 0)
                df_ = r["n"] - k
                errors = np.sqrt(np.maximum(np.diag(np.linalg.pinv(a)) * rest / df_, 0)) if df_ > 0 else [None] * k
                values = np.exp(beta) if logs else beta
                one = {key: r[key] for key in keys} | dict(zip(names, map(float, values)))
                one |= {f"se_{n}": None if e is None else float(e) for n, e in zip(names, errors)}
                out.append(one | {"r2": 1 - rest / spread if spread else None, "df": int(df_), "ss_resid": rest})
            yield pd.DataFrame(out)

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keys).schema]
    fields += [f"`{n}` double" for n in names] + [f"`se_{n}` double" for n in names] + ["r2 double", "df bigint", "ss_resid double"]
    return grouped.mapInPandas(solve, ", ".join(fields))


def predict(df: DataFrame, fit: DataFrame, keys: list[str], xs: list[str], logs: bool = False, name: str = "trend") -> DataFrame:
    """TREND (with ``logs`` GROWTH): the fitted values of ``df``'s rows, by a join on the keys."""
    coefficients = fit.select(*keys, *[F.col(x).alias(f"__b_{x}") for x in xs], F.col("intercept").alias("__b0"))
    joined = df.join(coefficients, keys) if keys else df.crossJoin(F.broadcast(coefficients))  # one row
    if logs:
        out = F.col("__b0")
        for x in xs:
            out = out * F.pow(F.col(f"__b_{x}"), F.col(x))
    else:
        out = F.col("__b0")
        for x in xs:
            out = out + F.col(f"__b_{x}") * F.col(x)
    return joined.withColumn(name, out).drop("__b0", *[f"__b_{x}" for x in xs])


# Functions of whole groups that need two passes or an order take a DataFrame.
for _names, _f in {("MODE", "MODE.SNGL"): mode_single, ("MODE.MULT",): modes, ("AVEDEV",): average_deviation, ("TRIMMEAN",): trimmed_mean, ("LINEST",): linear_fit, ("TREND",): predict}.items():
    fn(*_names)(_f)
fn("LOGEST")(lambda df, keys, y, xs, intercept=True: linear_fit(df, keys, y, xs, intercept, logs=True))
fn("GROWTH")(lambda df, fit, keys, xs, name="growth": predict(df, fit, keys, xs, logs=True, name=name))
