"""Lookups with wildcards where both the patterns and the searched values are tables.

A pattern is found by its rarest literal piece of three characters: texts and patterns meet in an equality
join on that piece, and only pairs that share it are compared in full. Patterns without wildcards join on
the whole text, those without literals on the length. No pair of rows is formed that shares nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.ordered import cut_points
from gridloom.staging import staged

GRAM = 3  # characters of an indexed piece; shorter literals are their own pieces
_MARKS = (("~~", "\ue000", "~", "~"), ("~*", "\ue001", "*", "\\*"), ("~?", "\ue002", "?", "\\?"))  # escape, mark, text, regular expression


def folded(x: Column) -> Column:
    return F.lower(x.cast("string"))


def _marked(pattern: Column) -> Column:
    out = folded(pattern)
    for escape, mark, _, _ in _MARKS:
        out = F.replace(out, F.lit(escape), F.lit(mark))
    return out


def _plain(marked: Column) -> Column:
    for _, mark, text, _ in _MARKS:
        marked = F.replace(marked, F.lit(mark), F.lit(text))
    return marked


def pattern_regex(pattern: Column) -> Column:
    """Wildcards of a column as regular expressions over lower-case text: * any run, ? one character, ~ makes the next plain."""
    out = F.regexp_replace(_marked(pattern), r"([\\.\[\]{}()+^$|])", r"\\$1")
    for wild, regex in (("*", ".*"), ("?", ".")):
        out = F.replace(out, F.lit(wild), F.lit(regex))
    for _, mark, _, regex in _MARKS:
        out = F.replace(out, F.lit(mark), F.lit(regex))
    return F.concat(F.lit("(?s)^"), out, F.lit("$"))


def _grams(text: Column, n: int) -> Column:
    """All pieces of n characters of a text."""
    chars = F.split(text, "")
    out = F.filter(chars, lambda x: x != "")
    whole = out
    for i in range(1, n):
        out = F.zip_with(out, F.slice(whole, F.lit(i + 1), F.greatest(F.size(whole), F.lit(1))), lambda a, b: F.concat(a, b))
    return F.filter(out, lambda x: x.isNotNull())


def _tag(n: int):
    return lambda g: F.concat(F.lit(f"g{n}"), g)


def _as_long_as(n: int):
    return lambda p: F.char_length(p) == n


def _pattern_keys(patterns: DataFrame) -> DataFrame:
    """(pattern, key): the keys under which a text that fits may be found; any one of them will do."""
    marked = _marked(F.col("pattern"))
    pieces = F.filter(F.transform(F.split(marked, r"[*?]+"), _plain), lambda p: p != "")
    longest = F.array_max(F.transform(pieces, F.char_length))
    long = F.flatten(F.transform(F.filter(pieces, lambda p: F.char_length(p) >= GRAM), lambda p: F.transform(_grams(p, GRAM), _tag(GRAM))))
    keys = F.when(~F.rlike(marked, F.lit("[*?]")), F.array(F.concat(F.lit("="), _plain(marked))))
    keys = keys.when(longest >= GRAM, F.array_distinct(long))
    for n in range(GRAM - 1, 0, -1):
        keys = keys.when(longest == n, F.transform(F.filter(pieces, _as_long_as(n)), _tag(n)))
    keys = keys.when(F.contains(marked, F.lit("*")), F.array(F.lit("a"))).otherwise(F.array(F.concat(F.lit("l"), F.char_length(marked).cast("string"))))
    return patterns.where(F.col("pattern").isNotNull()).select("pattern", F.explode(keys).alias("key"))


def _text_keys(texts: DataFrame, kinds: list[str]) -> DataFrame:
    """(text, ..., key) of each kind of key that patterns have."""
    t, found = F.col("text"), []
    for kind in kinds:
        if kind[0] == "g":
            n = int(kind[1])
            found.append(F.transform(F.array_distinct(_grams(t, n)), _tag(n)))
        else:
            found.append(F.array({"=": F.concat(F.lit("="), t), "a": F.lit("a"), "l": F.concat(F.lit("l"), F.char_length(t).cast("string"))}[kind]))
    whole = F.concat(*found) if found else F.array().cast("array<string>")
    return texts.withColumn("key", F.explode(whole))


def _indexed(patterns: DataFrame, texts: DataFrame) -> tuple[DataFrame, list[str]]:
    """(pattern, key, regex) with each pattern's rarest key among the texts, staged, and the kinds of keys in use."""
    keys = _pattern_keys(patterns)
    kinds = sorted(r[0] for r in keys.select(F.when(F.col("key").startswith("g"), F.substring("key", 1, 2)).otherwise(F.substring("key", 1, 1)).alias("k")).distinct().collect())  # six at most
    counted = _text_keys(texts.select("text"), kinds).join(keys.select("key").distinct(), "key", "left_semi").groupBy("key").agg(F.count("*").alias("n"))
    rarest = keys.join(counted, "key", "left").groupBy("pattern").agg(F.min_by("key", F.struct(F.coalesce("n", F.lit(0)), F.col("key"))).alias("key"))
    return staged(rarest.withColumn("regex", pattern_regex(F.col("pattern"))), "patterns"), kinds


def _pairs(indexed: DataFrame, texts: DataFrame, kinds: list[str]) -> DataFrame:
    """Each pattern with every text that fits it."""
    both = _text_keys(texts, kinds).join(indexed, "key")
    return both.where(F.col("key").startswith("=") | F.rlike("text", F.col("regex"))).drop("key", "regex")


def wildcard_lookup(left: DataFrame, on: str, right: DataFrame, key: str, take: list[str], order: str, default: dict | None = None, spans: tuple[int, ...] = (1, 8, 64)) -> DataFrame:
    """XLOOKUP 2 and MATCH 0 with patterns from ``left``: ``take`` of the first row of ``right``, by ``order``, whose ``key`` fits.

    ``right`` is searched in as many rounds as ``spans`` has numbers, each up to so many 64ths of its order,
    and a pattern that has its row takes no part in later ones: frequent pieces find theirs early. Text
    compares without case; NULL patterns and NULL values never match. Rows of equal ``order`` and text
    count as one, of which any may be taken.
    """
    picked = F.struct(F.col(order).alias("__order"), F.struct(*[F.col(c) for c in take]).alias("__take"))
    texts = staged(right.where(F.col(key).isNotNull()).groupBy(folded(F.col(key)).alias("text")).agg(F.min_by(picked, order).alias("p")).select("text", F.col("p.__order").alias("place"), F.col("p.__take").alias("found")), "texts")
    indexed, kinds = _indexed(left.select(folded(F.col(on)).alias("pattern")).distinct(), texts)
    cuts, hits, low = [r[0] for r in cut_points(texts, ["place"], 64)], None, None
    for span in spans:
        high = cuts[span - 1] if span - 1 < len(cuts) and span < spans[-1] else None
        part = texts if low is None else texts.where(F.col("place") >= F.lit(low))
        part = part if high is None else part.where((F.col("place") < F.lit(high)) | F.col("place").isNull())
        open_ = indexed if hits is None else indexed.join(hits.select("pattern"), "pattern", "left_anti")
        new = staged(_pairs(open_, part, kinds).groupBy("pattern").agg(F.min_by("found", "place").alias("found")), "matched")
        hits = new if hits is None else hits.unionByName(new)
        low = high
        if high is None:
            break
    out = left.join(hits.withColumnRenamed("pattern", "__pattern"), folded(F.col(on)) == F.col("__pattern"), "left")
    missing = F.col("__pattern").isNull()
    kept = [F.col(f"`{c}`") for c in left.columns if c not in take]
    return out.select(*kept, *[F.when(missing, F.lit((default or {}).get(c))).otherwise(F.col(f"found.{c}")).alias(c) for c in take])


def wildcard_position(left: DataFrame, on: str, right: DataFrame, key: str, order: str, name: str = "position") -> DataFrame:
    """MATCH 0 with wildcards: the place, from 1, of the first row of ``right`` that fits; ``order`` counts rows from 0."""
    return wildcard_lookup(left, on, right.withColumn(name, (F.col(order) + 1).cast("bigint")), key, [name], order)


def wildcard_counts(left: DataFrame, on: str, right: DataFrame, key: str, name: str = "matches", value: str | None = None) -> DataFrame:
    """COUNTIF, or SUMIF of ``value``, with a pattern in each row of ``left``: how many rows of ``right`` fit it."""
    amount = F.count("*").cast("bigint") if value is None else F.sum(value)
    texts = staged(right.where(F.col(key).isNotNull()).groupBy(folded(F.col(key)).alias("text")).agg(amount.alias("n")), "texts")
    indexed, kinds = _indexed(left.select(folded(F.col(on)).alias("pattern")).distinct(), texts)
    counts = _pairs(indexed, texts, kinds).groupBy(F.col("pattern").alias("__pattern")).agg(F.sum("n").alias(name))
    out = left.join(counts, folded(F.col(on)) == F.col("__pattern"), "left").drop("__pattern")
    return out.withColumn(name, F.coalesce(name, F.lit(0)))
