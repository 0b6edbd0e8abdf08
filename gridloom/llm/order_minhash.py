"""Document fingerprints by order MinHash, in DataFrame operations only.

A text's word k-mers are numbered by occurrence, so that repeated k-mers differ. Each tuple of the
signature takes the minimal k-mers under its own hash orders, puts them in the order in which they stand
in the text and hashes them: texts agree on a tuple when they share its k-mers and their order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridloom.llm.common import parallelism

#: Low bits of a minimum: the k-mer's place in the text; the rest is its hash.
_BITS = 31  # of a place, which is an int; a hash has the other 33
_PLACE = (1 << _BITS) - 1
_LOWEST = -(1 << 63)
MOST_BUCKETS = 4096


def _let(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def numbered_kmers(text: Column, k: int) -> Column:
    """array<struct<v bigint, at int>>: hashes of (k-mer, occurrence), each with its place in the text.

    Words are runs of non-white-space; a text of fewer than k words is one k-mer, one without words none.
    """
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def hashes(w: Column) -> Column:
        many = F.transform(
            F.sequence(F.lit(0), F.size(w) - k), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)])
        )
        none = F.array().cast("array<bigint>")
        return F.when(F.size(w) >= k, many).when(F.size(w) > 0, F.array(F.xxhash64(F.array_join(w, " ")))).otherwise(none)

    def plain(h: Column) -> Column:
        return F.transform(h, lambda x, i: F.struct(F.xxhash64(x, F.lit(0)).alias("v"), i.alias("at")))

    def repeated(h: Column) -> Column:
        def runs(s: Column) -> Column:
            places = F.sequence(F.lit(0), F.size(s) - 1)
            begins = F.filter(places, lambda i: (i == 0) | (F.get(s, i)["h"] != F.get(s, i - 1)["h"]))
            return _let(begins, lambda b: F.flatten(F.transform(b, lambda x, g: number(s, x, F.coalesce(F.get(b, g + 1), F.size(s))))))

        def number(s: Column, begin: Column, end: Column) -> Column:
            return F.transform(
                F.slice(s, begin + 1, end - begin),
                lambda e, nth: F.struct(F.xxhash64(e["h"], nth).alias("v"), e["at"].alias("at")),
            )

        placed = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("at"))))
        return _let(placed, runs)

    either = lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), plain(h)).otherwise(repeated(h))
    return _let(_let(words, hashes), either)


def _minima(tuples: int, width: int) -> list[Column]:
    """Minimal (hash, place) of the exploded k-mers under tuples * width hash orders, packed in longs."""
    place = F.col("kmer.at").cast("bigint")
    high = lambda j: F.shiftleft(F.shiftrightunsigned(F.xxhash64("kmer.v", F.lit(j)), _BITS), _BITS)
    return [F.min(high(j).bitwiseOR(place)).alias(f"m{j}") for j in range(tuples * width)]


def _signature(tuples: int, width: int) -> Column:
    """Hash each tuple's k-mers in the order of their places."""
    out = []
    for t in range(tuples):
        picked = [F.col(f"m{t * width + j}") for j in range(width)]
        parts = [F.struct(p.bitwiseAND(F.lit(_PLACE).cast("bigint")).alias("at"), F.shiftrightunsigned(p, _BITS).alias("h")) for p in picked]
        out.append(F.xxhash64(F.array_sort(F.array(*parts)).getField("h")))
    return F.array(*out)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal tuples of two signatures, 0 to 1."""
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e)) / F.size(a)


def _as_text(signature: Column) -> Column:
    return F.array_join(F.transform(signature, lambda x: F.lower(F.hex(x))), " ")


def signatures(rows: DataFrame, keys: list[str], text_col: str, *, k: int = 3, tuples: int = 20, width: int = 2) -> DataFrame:
    """(keys, signature array<bigint>) of each row; ``keys`` must name the rows uniquely.

    The k-mers of a row are aggregated where they are made, so one row of minima is shuffled for it.
    Texts without words share one fixed signature.
    """
    exploded = rows.select(*keys, F.explode_outer(numbered_kmers(F.col(text_col), k)).alias("kmer"))
    return exploded.groupBy(*keys).agg(*_minima(tuples, width)).select(*keys, _signature(tuples, width).alias("signature"))


def _ordered(docs: DataFrame, buckets: int | None) -> DataFrame:
    """Documents in descending doc_id, cut into buckets by id, each closed by a guard: the next bucket's first."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("sid", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LOWEST)))
    if buckets is None:
        buckets = min(MOST_BUCKETS, max(docs.count() // 4000, 4 * parallelism(spark)))
    shares = [i / buckets for i in range(1, buckets)] or [0.5]
    cuts = docs.agg(F.percentile_approx("sid", F.array(*map(F.lit, shares)), 20 * buckets)).first()[0] or []
    cuts = F.array(*[F.lit(c) for c in sorted(set(cuts))]).cast("array<bigint>")
    docs = docs.withColumn("bucket", F.size(F.filter(cuts, lambda c: c <= F.col("sid"))))
    tops = sorted((r[0], r[1]) for r in docs.groupBy("bucket").agg(F.max("sid")).collect())  # one row a bucket
    guards = [(top, upper[0]) for (_, top), upper in zip(tops, tops[1:] + tops[:1])]
    guarded = {top: bucket for top, bucket in guards}
    # the first of each bucket also closes the bucket above it; the very first closes the last one
    also = F.create_map(*[F.lit(x) for top in sorted(guarded) for x in (top, guarded[top])]) if guarded else None
    here = F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("guard"))
    if also is not None:
        is_top = F.col("sid").isin(sorted(guarded))
        there = F.struct(F.try_element_at(also, F.col("sid")).alias("bucket"), F.lit(True).alias("guard"))
        spread = F.when(is_top, F.array(here, there)).otherwise(F.array(here))
    else:
        spread = F.array(here)
    return docs.select("doc_id", "sid", "text", F.explode(spread).alias("x")).select("doc_id", "sid", "text", "x.*")


def fingerprint_edits(docs: DataFrame, *, k: int = 3, tuples: int = 20, width: int = 2, buckets: int | None = None) -> DataFrame:
    """Fingerprint every whole text and an edited form of it, and compare them.

    The edited text replaces the last floor(n_chars / 3) code points by the first as many (or all) of the
    next document in descending doc_id; after the last comes the first. Columns: doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Null text counts as empty; empty texts share one fingerprint. Null doc_ids come last. Rows that repeat
    a doc_id follow each other in the order of their texts. Further columns are ignored. One shuffle moves
    the texts, into buckets of neighbouring ids; only signatures move after that.
    """
    order = Window.partitionBy("bucket").orderBy("guard", F.desc("sid"), "text")
    rows = _ordered(docs, buckets).withColumn("rn", F.row_number().over(order)).withColumn("next", F.lead("text").over(order))
    n = F.char_length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - cut), F.substring(F.col("next"), F.lit(1), cut))
    rows = rows.select("bucket", "rn", "guard", "doc_id", n.cast("bigint").alias("n_chars"), "text", edited.alias("edited"))
    own = F.struct(F.lit(0).alias("side"), F.col("text").alias("text"), F.lit(None).cast("string").alias("sha"))
    other = F.struct(F.lit(1).alias("side"), F.col("edited").alias("text"), F.sha2("edited", 256).alias("sha"))
    keys = ["bucket", "rn", "guard", "doc_id", "n_chars"]
    sides = rows.select(*keys, F.explode(F.when(F.col("guard"), F.array(own)).otherwise(F.array(own, other))).alias("s"))
    keys += ["side", "sha"]
    signed = signatures(sides.select(*keys[:5], "s.*"), keys, "text", k=k, tuples=tuples, width=width)
    order = Window.partitionBy("bucket").orderBy("rn", "side")
    for name, col, ahead in (("edited_signature", "signature", 1), ("edited_sha256", "sha", 1), ("next_signature", "signature", 2)):
        signed = signed.withColumn(name, F.lead(col, ahead).over(order))
    mine = signed.where("side = 0 and not guard")
    return mine.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        _as_text(F.col("signature")).alias("fingerprint"),
        _as_text(F.col("edited_signature")).alias("edited_fingerprint"),
        likeness(F.col("signature"), F.col("edited_signature")).alias("near_edited"),
        likeness(F.col("signature"), F.col("next_signature")).alias("near_next"),
    )
