"""Byte-level BPE encoding and decoding inside Spark's higher-order functions.

A text is cut by the tokenizer's pattern; a word's bytes become ids and a fold merges the adjacent pair
of lowest rank, the leftmost of equals, until none is left. The rank map is a constant of the plan: a flat
array without collisions, so that one look finds a pair. Frequent distinct words are folded once, ahead,
into a second constant of bounded size; a rarer word is folded where it stands. Decoding looks up the ids'
byte pieces and joins them. No step shuffles documents.

Constants are one-row tables read by scalar subqueries: tasks see literal values, while plans and their
texts, of which the driver keeps many, hold only references.
"""

from __future__ import annotations

import base64
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import discard, stage_table

#: ``\s`` of Unicode's White_Space property, spelled out because Java's ``\s`` is ASCII only.
_SPACE = r"\u0009-\u000D\u0020\u0085\u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
_SHIFT = 17  # bits of an id
_NONE = (1 << _SHIFT) - 1
_PLACE = 29  # bits of a place in a word


def java_pattern(pattern: str) -> str:
    """The tokenizer's pattern with white space as Unicode defines it."""
    return pattern.replace(r"[^\s", "[^" + _SPACE).replace(r"\S", f"[^{_SPACE}]").replace(r"\s", f"[{_SPACE}]")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def spread(bucket_hash: np.ndarray, slot_hash: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(shift of each bucket, slot of each key, number of slots), so that no two keys share a slot.

    A key's bucket is ``bucket_hash`` modulo the number of shifts, its slot ``slot_hash`` plus the bucket's
    shift modulo the number of slots. The largest bucket is placed first; slots are half as many again as
    keys. Keys of one bucket must differ in ``slot_hash``; both hashes are 0 or more.
    """
    buckets = max(1, len(bucket_hash) // 2)
    own = bucket_hash % buckets
    order = np.argsort(own, kind="stable")
    sizes = np.bincount(own, minlength=buckets)
    begins = np.cumsum(sizes) - sizes
    size = len(own) + len(own) // 2 + 7
    while True:
        hashes, taken, shifts = slot_hash % size, bytearray(size), np.zeros(buckets, np.int64)
        for b in np.argsort(-sizes, kind="stable")[: np.count_nonzero(sizes)].tolist():
            keys = hashes[order[begins[b] : begins[b] + sizes[b]]].tolist()
            if len(set(keys)) < len(keys):
                break  # no shift parts two of them: another size may
            shift = 0
            while any(taken[(k + shift) % size] for k in keys):
                shift += 1
            shifts[b] = shift
            for k in keys:
                taken[(k + shift) % size] = 1
        else:
            return shifts, (hashes + shifts[own]) % size, size
        size += 2


def _with_literals(df: DataFrame, literals: list[Column], name: str, body) -> DataFrame:
    """``df`` with the column ``name``, which is ``body(struct of literals)``.

    Subqueries may not stand inside lambdas, so they come in by a column of their own, used once, which
    the optimizer merges into the column that reads it: no row ever carries the constants.
    """
    held = df.withColumn("__literals", F.struct(*literals))
    return held.withColumn(name, _let(F.col("__literals"), body)).drop("__literals")


def _long_list(values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, pa.int64()))


class Codec:
    """The constants of one vocabulary of ranks (a piece's rank is its id), staged once a session.

    Ids have 17 bits; a vocabulary with larger ones is refused.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        if max(ranks.values(), default=0) >= _NONE:
            raise ValueError(f"ids go up to {_NONE - 1}, the vocabulary's up to {max(ranks.values())}")
        self.pattern, self.ranks = java_pattern(pattern), ranks
        self._staged: tuple[SparkSession, DataFrame] | None = None

    def constants(self, spark: SparkSession) -> DataFrame:
        """One row: shifts and slots of the pairs, the ids of single bytes, and the pieces by id."""
        if self._staged is None or self._staged[0] is not spark:
            ranks = self.ranks
            found = np.array([
                (ranks[piece[:cut]], ranks[piece[cut:]], rank)
                for piece, rank in ranks.items()
                for cut in range(1, len(piece))
                if piece[:cut] in ranks and piece[cut:] in ranks
            ], np.int64).reshape(-1, 3)
            left, right, rank = found.T
            number = left << _SHIFT | right
            shifts, slots, size = spread(number, number)
            pairs = np.full(size, 1 << 62, np.int64)
            pairs[slots] = number << _SHIFT | rank
            pieces = [b""] * (max(ranks.values()) + 1)
            for piece, i in ranks.items():
                pieces[i] = piece
            letters = np.array([ranks[bytes([i])] for i in range(256)])
            row = pa.table({
                "shifts": _long_list(shifts),
                "pairs": _long_list(pairs),
                "letters": _long_list(letters),
                "pieces": pa.ListArray.from_arrays(pa.array([0, len(pieces)], pa.int32()), pa.array(pieces, pa.binary())),
            })
            self._staged = spark, stage_table(spark.createDataFrame(row).coalesce(1), "codec")
            self._sizes = len(shifts), size
        return self._staged[1]

    def words(self, text: Column) -> Column:
        return F.regexp_extract_all(text, F.lit(self.pattern), F.lit(0))

    def literals(self, spark: SparkSession) -> list[Column]:
        """The constants that ``fold`` needs, for ``_with_literals``."""
        return [self.constants(spark).select(c).scalar().alias(c) for c in ("shifts", "pairs", "letters")]

    def fold(self, word: Column, literals: Column) -> Column:
        """Ids of one word: bytes first, then merges in the order of their ranks.

        The state holds a long for each id: the rank of the pair that starts there, the place, the id. So
        the least entry is the next merge, the first of several alike, and its rank is the merged piece's id.
        """
        shifts, pairs, letters = (literals[c] for c in ("shifts", "pairs", "letters"))
        number = lambda n: F.lit(n).cast("bigint")
        buckets, size = map(number, self._sizes)
        none, last = number(_NONE), number(_NONE << (_PLACE + _SHIFT))
        low = lambda x, bits: x.bitwiseAND(number((1 << bits) - 1))

        def entry(x: Column) -> Column:
            """State entry of (place, left id, right id) in one long; pairs are numbered by their ids."""
            pair = low(x, 2 * _SHIFT)
            shift = F.get(shifts, (pair % buckets).cast("int"))
            found = F.get(pairs, ((pair + shift) % size).cast("int"))
            rank = F.least(found.bitwiseXOR(F.shiftleft(pair, _SHIFT)), none)  # another pair differs above a rank's bits
            return F.shiftleft(rank, _PLACE + _SHIFT) + F.shiftright(x, _SHIFT)

        def start(ids: Column) -> Column:
            right = lambda i: F.coalesce(F.get(ids, i + 1), none)
            placed = F.transform(ids, lambda x, i: F.shiftleft(i.cast("bigint"), 2 * _SHIFT) + F.shiftleft(x, _SHIFT) + right(i))
            return F.transform(placed, entry)

        def merge(state: Column, least: Column, at: Column) -> Column:
            best, left, right = F.shiftright(least, _PLACE + _SHIFT), F.get(state, at - 2), F.get(state, at + 1)
            before = F.shiftleft(low(left, _PLACE + _SHIFT), _SHIFT) + best
            place = least.bitwiseAND(number(((1 << _PLACE) - 1) << _SHIFT))
            own = F.shiftleft(place + best, _SHIFT) + F.coalesce(low(right, _SHIFT), none)

            def short(new: Column) -> Column:
                put = lambda held: F.transform(state, lambda x, i: F.coalesce(F.get(held, i + (2 - at)), x))
                return F.array_remove(_let(F.concat(new, F.array(number(-1))), put), number(-1))  # the pair's second entry goes

            def long(new: Column) -> Column:  # plain copies are faster in long words, slower in short ones
                own = F.when(at > 1, new).otherwise(F.slice(new, 2, 1))
                return F.concat(F.slice(state, F.lit(1), F.greatest(at - 2, F.lit(0))), own, F.slice(state, at + 2, F.size(state)))

            return _let(F.transform(F.array(before, own), entry), lambda new: F.when(F.size(state) > 64, long(new)).otherwise(short(new)))

        def step(state: Column, _: Column) -> Column:
            def found(least: Column) -> Column:
                at = F.array_position(state, least).cast("int")
                return F.when(least >= last, state).otherwise(_let(at, lambda at: merge(state, least, at)))

            return _let(F.array_min(state), found)

        singles = F.transform(F.split(F.decode(word.cast("binary"), "ISO-8859-1"), ""), lambda c: F.get(letters, F.ascii(c)))
        whole = lambda state: F.transform(state, lambda x: low(x, _SHIFT).cast("int"))
        return _let(singles, lambda ids: F.aggregate(F.slice(ids, F.lit(2), F.size(ids)), start(ids), step, whole))

    def known(self, docs: DataFrame, text_col: str, most: int) -> tuple[list[Column], Callable[[Column, Column], Column]]:
        """(constants, function of a word and their struct to the word's ids, null for words that are not known).

        Known are the vocabulary's own pieces, each one token as a whole, and the most frequent words, at
        most ``most`` of them: octaves of counts are taken from the top while they fit. The table only
        saves work: a word it lacks is folded in place. Only hashes of the known words reach the driver.
        """
        spark = docs.sparkSession
        counts = docs.select(F.explode(self.words(F.col(text_col))).alias("word")).groupBy("word").count()
        counts = stage_table(counts.where("count > 1"), "words")
        octave = F.floor(F.log2("count") * 8)
        held, least = 0, None
        for r in counts.groupBy(octave.alias("o")).agg(F.count("*").alias("n"), F.min("count").alias("c")).orderBy(F.desc("o")).collect():
            held += r.n
            if held > most:
                break
            least = r.c
        frequent = counts.where(F.col("count") >= least if least else F.lit(False)).select("word")
        pieces = self.constants(spark).select(F.posexplode("pieces").alias("rank", "word")).withColumn("word", F.col("word").cast("string"))
        pieces = pieces.where(F.is_valid_utf8("word") & (F.col("word") != "")).select("word", F.array("rank").alias("ids"))
        rare = frequent.join(pieces.select("word"), "word", "left_anti")
        rare = _with_literals(rare, self.literals(spark), "ids", lambda held: self.fold(F.col("word"), held))
        rows = stage_table(rare.unionByName(pieces), "folded")
        discard(counts)

        hashes = lambda word: (F.shiftrightunsigned(F.xxhash64(word), 32), F.xxhash64(word).bitwiseAND(F.lit((1 << 32) - 1)))
        got = rows.select(*[h.alias(n) for h, n in zip(hashes(F.col("word")), "ab")]).toArrow()
        shifts, _, size = spread(*(got[c].to_numpy() for c in "ab"))
        table = stage_table(spark.createDataFrame(pa.table({"places": _long_list(shifts)})).coalesce(1), "places")
        places = table.select("places").scalar().alias("places")

        def slot(word: Column, held: Column) -> Column:
            bucket, own = hashes(word)
            return ((own + F.get(held["places"], (bucket % len(shifts)).cast("int"))) % size).cast("int")

        placed = _with_literals(rows, [places], "slot", lambda held: slot(F.col("word"), held))
        placed = spark.range(size).select(F.col("id").cast("int").alias("slot")).join(placed, "slot", "left")
        whole = placed.agg(F.array_sort(F.collect_list(F.struct("slot", "word", "ids"))).alias("all"))
        whole = stage_table(whole.select(F.col("all.word").alias("words"), F.col("all.ids").alias("word_ids")), "known")
        discard(rows)

        def find(word: Column, held: Column) -> Column:
            return _let(slot(word, held), lambda at: F.when(F.get(held["words"], at) == word, F.get(held["word_ids"], at)))

        return [places, *(whole.select(c).scalar().alias(c) for c in whole.columns)], find


def encode(
    docs: DataFrame, codec: Codec, *, text_col: str = "text", out_col: str = "ids", frequent_words: int = 400_000
) -> DataFrame:
    """``docs`` with ``out_col``, the token ids (array<int>) of the whole text; special tokens do not exist.

    Null and empty texts give an empty array. Rows, ties and further columns are untouched; a column
    named like ``out_col`` is replaced. A single match of the pattern costs time in proportion to the
    square of its length, any number of matches in proportion to their number.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    literals, known = codec.known(docs.select(text.alias("text")), "text", frequent_words)

    def ids(held: Column) -> Column:
        return F.flatten(F.transform(codec.words(text), lambda w: F.coalesce(known(w, held), codec.fold(w, held))))

    return _with_literals(docs, [*codec.literals(docs.sparkSession), *literals], out_col, ids)


def decode(docs: DataFrame, codec: Codec, *, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``docs`` with ``out_col``, the binary that the ids stand for; null for null ids, empty for none.

    An id outside the vocabulary makes the whole value null.
    """
    pieces = codec.constants(docs.sparkSession).select(F.col("pieces").cast("array<string>")).scalar().alias("pieces")

    def joined(held: Column) -> Column:
        parts = F.transform(F.col(f"`{ids_col}`"), lambda i: F.get(held["pieces"], i))
        return _let(parts, lambda all: F.when(~F.exists(all, lambda p: p.isNull()), F.array_join(all, "")))

    out = _with_literals(docs, [pieces], out_col, joined)
    return out.withColumn(out_col, F.col(out_col).cast("binary"))
