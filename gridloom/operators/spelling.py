"""Edit distance with transpositions, and the nearest words of a dictionary that is a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def edits(a: str, b: str) -> int:
    """Insertions, deletions, substitutions and swaps of neighbours between two words; no place is edited twice."""
    rows = [list(range(len(b) + 1))]
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            best = min(rows[-1][j] + 1, row[-1] + 1, rows[-1][j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and y == a[i - 2]:
                best = min(best, rows[-2][j - 2] + 1)
            row.append(best)
        rows.append(row)
    return rows[-1][-1]


def closest(name: str, names: Sequence[str], most: int = 2) -> str | None:
    """The nearest of some names without case, if it is within ``most`` edits; of equal ones the first."""
    near = min(((edits(name.lower(), n.lower()), i) for i, n in enumerate(names)), default=(most + 1, 0))
    return names[near[1]] if near[0] <= most else None


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def edit_distance(a: Column, b: Column) -> Column:
    """``edits`` of two text columns, as a fold over rows of the table of distances; NULL with NULL."""
    chars = lambda x: F.filter(F.split(x, ""), lambda c: c != "")

    def rows(w: Column) -> Column:
        s, t = w["s"], w["t"]

        def next_row(state: Column, x: Column) -> Column:
            i, up, before = state["i"] + 1, state["up"], state["before"]

            def cell(row: Column, y: Column) -> Column:
                j = F.size(row)  # the cell to be made stands in column j
                cost = F.when(y == x, 0).otherwise(1)
                best = F.least(F.get(up, j) + 1, F.element_at(row, -1) + 1, F.get(up, j - 1) + cost)
                swap = (i > 1) & (j > 1) & (x == F.get(t, j - 2)) & (y == F.get(s, i - 2))
                return F.concat(row, F.array(F.when(F.coalesce(swap, F.lit(False)), F.least(best, F.get(before, j - 2) + 1)).otherwise(best)))

            return F.struct(i.alias("i"), F.aggregate(t, F.array(i), cell).alias("up"), up.alias("before"))

        start = F.struct(F.lit(0).alias("i"), F.transform(F.sequence(F.lit(0), F.size(t)), lambda j: j).alias("up"), F.array().cast("array<int>").alias("before"))
        return F.element_at(F.aggregate(s, start, next_row)["up"], -1)

    return F.when(a.isNotNull() & b.isNotNull(), _let(F.struct(chars(a).alias("s"), chars(b).alias("t")), rows))


def _deletions(word: Column, most: int) -> Column:
    """The word and all that is left of it without up to ``most`` characters."""
    found = F.array(word)
    for _ in range(most):
        shorter = F.flatten(F.transform(found, lambda w: F.when(F.char_length(w) > 0, F.transform(F.sequence(F.lit(1), F.char_length(w)), lambda i: F.concat(F.substring(w, F.lit(1), i - 1), F.substring(w, i + 1, F.char_length(w))))).otherwise(F.array().cast("array<string>"))))
        found = F.array_distinct(F.concat(found, shorter))
    return found


def _keys(words: DataFrame, most: int, searched: bool) -> DataFrame:
    """(word, key): two words within ``most`` edits share a key.

    Short words meet by what deletions leave of them. Longer ones are cut into 2 ``most`` + 1 pieces, of which
    an edit touches two at most: one piece of the word searched for stands whole in the other one, shifted
    by up to ``most`` places.
    """
    w, n, parts = F.col("word"), F.char_length("word"), 2 * most + 1
    short = F.when(n <= 3 * most, F.transform(_deletions(w, most), lambda x: F.concat(F.lit("d"), x))).otherwise(F.array().cast("array<string>"))
    pieces = []
    for gap in [0] if searched else range(-most, most + 1):
        size = n + gap  # of the word searched for
        for p in range(parts):
            first, last = F.floor(size * p / parts), F.floor(size * (p + 1) / parts)
            for shift in [0] if searched else range(-most, most + 1):
                at = first + shift
                text = F.substring(w, (at + 1).cast("int"), (last - first).cast("int"))
                good = (size >= parts) & (at >= 0) & (at + (last - first) <= n)
                pieces.append(F.when(good, F.concat_ws("\u0001", F.lit("p"), size.cast("string"), F.lit(p).cast("string"), text)))
    return words.select("word", F.explode(F.array_distinct(F.concat(short, F.filter(F.array(*pieces), lambda x: x.isNotNull())))).alias("key"))


def near_pairs(left: DataFrame, right: DataFrame, most: int = 2) -> DataFrame:
    """(word, other, distance) of all distinct words of two tables (a column ``word`` each) within ``most`` edits.

    Joined on keys that near words share, then measured; a word has some dozens of keys, however long it is.
    """
    other = _keys(right, most, False).withColumnRenamed("word", "other")
    pairs = _keys(left, most, True).join(other, "key").select("word", "other").distinct()
    return pairs.withColumn("distance", edit_distance(F.col("word"), F.col("other"))).where(F.col("distance") <= most)


def nearest_words(df: DataFrame, on: str, dictionary: DataFrame, key: str, most: int = 2, name: str = "nearest") -> DataFrame:
    """``df`` with the nearest word of a dictionary within ``most`` edits, without case, and its ``distance``.

    Of equally near words the first by the alphabet counts; NULL where there is none, and for NULL.
    """
    words = df.where(F.col(on).isNotNull()).select(F.lower(F.col(on)).alias("word")).distinct()
    known = dictionary.where(F.col(key).isNotNull()).select(F.lower(F.col(key)).alias("word")).distinct()
    best = near_pairs(words, known, most).groupBy("word").agg(F.min(F.struct("distance", "other")).alias("b"))
    hit = best.select(F.col("word").alias("__word"), F.col("b.other").alias(name), F.col("b.distance").alias("distance"))
    return df.drop(name, "distance").join(hit, F.lower(F.col(on)) == F.col("__word"), "left").drop("__word")
