"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification.

Two permutations of the 32-bit numbers serve all signature coordinates: the first scatters a shingle,
the second, circularly shifted by k, gives coordinate k. Documents that agree on a whole band meet in a
bucket. Buckets are never expanded into all pairs: members are first verified against the bucket's
smallest one, which joins copies into components; only buckets that still hold several components are
searched further, by an exact prefix-filtered join between components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridloom.llm.common import slices, stage_table

_U32, _U64 = np.uint32, np.uint64
PARITY_WORDS = 16  # of 64 bits


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of the 64-bit numbers (an xor-shift and multiply finaliser)."""
    x = x ^ (x >> _U64(33))
    x = x * _U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U64(33))
    x = x * _U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U64(33))


def permute32(x: np.ndarray) -> np.ndarray:
    """The second permutation: a bijection of the 32-bit numbers, computed in place."""
    x ^= x >> _U32(16)
    x *= _U32(0x85EBCA6B)
    x ^= x >> _U32(13)
    x *= _U32(0xC2B2AE35)
    x ^= x >> _U32(16)
    return x


class Shingler:
    """Distinct word-shingle hashes of texts; words are runs of non-white-space with A-Z lower-cased."""

    def __init__(self, words: int):
        self.words, self.seen = words, {}

    def _hashes(self, words: list[bytes]) -> list[int]:
        if len(self.seen) > 2_000_000:
            self.seen.clear()
        seen, out = self.seen, []
        for w in words:
            h = seen.get(w)
            if h is None:
                h = seen[w] = xxhash.xxh3_64_intdigest(w)
            out.append(h)
        return out

    def sets(self, texts: list[str | None]) -> list[np.ndarray]:
        """Sorted distinct 64-bit shingle hashes of each text; without words, none."""
        rows = [self._hashes((t or "").encode("utf-8", "surrogatepass").lower().split()) for t in texts]
        sizes = [len(r) for r in rows]
        flat = np.fromiter((h for r in rows for h in r), _U64, sum(sizes))
        k, n = self.words, len(flat)
        combined = np.zeros(max(0, n - k + 1), _U64)
        for j in range(k):
            combined = combined * _U64(0x9E3779B97F4A7C15) + flat[j : j + len(combined)]
        combined = mix64(combined)
        out, at = [], 0
        for size in sizes:
            if size >= k:
                own = np.sort(combined[at : at + size - k + 1])
                out.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
            elif size:
                whole = xxhash.xxh3_64_intdigest(flat[at : at + size].tobytes(), seed=size)
                out.append(np.array([whole], _U64))
            else:
                out.append(np.zeros(0, _U64))
            at += size
        return out


def signatures(sets: list[np.ndarray], coordinates: int, chunk: int = 1 << 14) -> np.ndarray:
    """(len(sets), coordinates) circulant MinHash values; every set must have a member."""
    out = np.empty((len(sets), coordinates), _U32)
    i = 0
    while i < len(sets):
        j, held = i, 0
        while j < len(sets) and (j == i or held + len(sets[j]) <= chunk):
            held += len(sets[j])
            j += 1
        starts = np.concatenate([[0], np.cumsum([len(s) for s in sets[i : j - 1]], dtype=np.int64)])
        scattered = (mix64(np.concatenate(sets[i:j]) ^ _U64(0x5851F42D4C957F2D)) >> _U64(32)).astype(_U32)
        for k in range(coordinates):
            out[i:j, k] = np.minimum.reduceat(permute32(scattered - _U32(k)), starts)
        i = j
    return out


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    """(n, bands) 64-bit keys; the band's number is part of its key."""
    rows = signature.reshape(len(signature), bands, -1).astype(_U64)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=_U64) * _U64(0xD6E8FEB86659FD93), rows.shape[:2]).copy()
    for r in range(rows.shape[2]):
        key = mix64(key ^ rows[:, :, r]) + _U64(r + 1)
    return key.view(np.int64)


def parity_bits(sets: list[np.ndarray]) -> np.ndarray:
    """(n, PARITY_WORDS) bitmaps in which each member of a set flips one bit.

    Two bitmaps differ in no more bits than the sets differ in members, so many differing bits rule a pair out.
    """
    size = 64 * PARITY_WORDS
    flat = mix64(np.concatenate(sets) + _U64(0x2545F4914F6CDD1D)) % _U64(size)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    odd = (np.bincount(row * size + flat.astype(np.int64), minlength=len(sets) * size) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(len(sets), size), axis=1).view(np.int64)


def set_key(own: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(own.tobytes())


def _sketch(docs: DataFrame, words: int, bands: int, rows: int, slice_bytes: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in slices(batches, "text", slice_bytes):
            sets = shingler.sets(batch.column("text").to_pylist())
            full = [i for i, s in enumerate(sets) if len(s)]
            keys = band_keys(signatures([sets[i] for i in full], bands * rows), bands).tolist() if full else []
            flips = parity_bits([sets[i] for i in full]).tolist() if full else []
            lists: list = [None] * len(sets)
            bits: list = [None] * len(sets)
            for i, key, flip in zip(full, keys, flips):
                lists[i], bits[i] = key, flip
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_key(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array(lists, pa.list_(pa.int64())),
                    pa.array(bits, pa.list_(pa.int64())),
                ],
                ["doc_id", "n_shingles", "set_key", "bands", "bits"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, n_shingles bigint, set_key binary, bands array<bigint>, bits array<bigint>"
    )


def _verify(pairs: DataFrame, docs: DataFrame, words: int, percent: int, slice_bytes: int) -> DataFrame:
    """Those of ``pairs`` (a, a_key, b, b_key) whose whole shingle sets are alike enough, as (a, b)."""
    text = docs.select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    joined = pairs.join(text.select(F.col("doc_id").alias("a"), F.col("text").alias("a_text")), "a")
    joined = joined.join(text.select(F.col("doc_id").alias("b"), F.col("text").alias("b_text")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        last: tuple = (None, None)
        for batch in slices(batches, "a_text", slice_bytes):
            out = []
            a_sets = shingler.sets(batch.column("a_text").to_pylist())
            b_text = batch.column("b_text")
            for i, (a, a_key, b, b_key) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("a", "a_key", "b", "b_key")))):
                if last[0] != b_key:
                    own = shingler.sets([b_text[i].as_py()])[0]
                    if set_key(own) != b_key:  # another row of the same doc_id
                        continue
                    last = (b_key, own)
                one, two = a_sets[i], last[1]
                if set_key(one) != a_key:
                    continue
                both = len(np.intersect1d(one, two, assume_unique=True))
                if 100 * both >= percent * (len(one) + len(two) - both):
                    out.append((a, b))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[j] for x in out], pa.int64()) for j in (0, 1)], ["a", "b"]
            )

    columns = ["a", "a_key", "a_text", "b", "b_key", "b_text"]
    return joined.select(*columns).mapInArrow(run, "a bigint, b bigint").distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node that can be reached, for each node of ``edges`` (a, b).

    Alternating large-star and small-star steps; each round is a written table, nothing is collected.
    """
    edges = stage_table(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        after = stage_table(small.select("e.*").where("a <> b").distinct(), "edges")
        same = [x.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first() for x in (edges, after)]
        edges = after
        if same[0] == same[1]:
            break
    else:
        raise RuntimeError("components did not settle")
    return edges.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")


def _fits(x: str, y: str, percent: int):
    """Sets of these sizes can be alike enough."""
    return F.least(x, y) * 100 >= F.greatest(x, y) * percent


def _near(percent: int):
    """Parity bitmaps ``bits`` and ``bits_2`` differ by no more than sets that are alike enough can."""
    differ = sum(F.bit_count(F.get(F.col("bits"), F.lit(i)).bitwiseXOR(F.get(F.col("bits_2"), F.lit(i)))) for i in range(PARITY_WORDS))
    return differ * (100 + percent) <= (100 - percent) * (F.col("n_shingles") + F.col("n_shingles_2"))


_MEMBER = ("class_id", "set_key", "n_shingles", "component", "bits")


def _within_buckets(member: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components in the same (small) bucket."""
    other = member.select("band", *[F.col(c).alias(f"{c}_2") for c in _MEMBER])
    return member.join(other, "band").where("component < component_2").where(_near(percent))


def _by_prefix(member: DataFrame, docs: DataFrame, words: int, percent: int, slice_bytes: int) -> DataFrame:
    """Pairs of different components that share one of their rarest shingles, as alike sets must.

    A set of n needs at least ceil(n * percent / 100) shingles in common with a partner, so the two share
    one of the n - that + 1 that come first in any common order; here the rarest come first.
    """
    own = member.select(*_MEMBER).dropDuplicates(["set_key"])
    text = docs.select(F.col("doc_id").alias("class_id"), F.coalesce("text", F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in slices(batches, "text", slice_bytes):
            sets = shingler.sets(batch.column("text").to_pylist())
            keys = batch.column("set_key").to_pylist()
            rows = [i for i, s in enumerate(sets) if set_key(s) == keys[i]]
            took = pa.array(np.repeat(np.array(rows, np.int64), [len(sets[i]) for i in rows]))
            flat = np.concatenate([sets[i] for i in rows] or [np.zeros(0, _U64)]).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("set_key").take(took), pa.array(flat, pa.int64())], ["set_key", "shingle"])

    shingles = stage_table(
        own.join(text, "class_id")
        .select("set_key", "text")
        .mapInArrow(run, "set_key binary, shingle bigint")
        .distinct(),
        "shingles",
    )
    common = shingles.groupBy("shingle").agg(F.count("*").alias("df"))
    first = Window.partitionBy("set_key").orderBy("df", "shingle")
    prefix = stage_table(
        shingles.join(common, "shingle")
        .join(own.select("set_key", "n_shingles"), "set_key")
        .withColumn("place", F.row_number().over(first))
        .where((F.col("place") <= F.col("n_shingles") - F.ceil(F.col("n_shingles") * percent / 100) + 1) & (F.col("df") > 1))
        .select("shingle", "set_key", "place")
        .join(own, "set_key"),
        "prefix",
    )
    other = prefix.select("shingle", *[F.col(c).alias(f"{c}_2") for c in (*_MEMBER, "place")])
    # What can still follow the shared shingle must be enough, too.
    enough = 100 * (F.least(F.col("n_shingles") - F.col("place"), F.col("n_shingles_2") - F.col("place_2")) + F.least("place", "place_2")) * (100 + percent) >= (
        F.lit(100 * percent) * (F.col("n_shingles") + F.col("n_shingles_2"))
    )
    return prefix.join(other, "shingle").where("component < component_2").where(enough).where(_near(percent))


def link_near_duplicates(
    docs: DataFrame,
    *,
    words: int = 5,
    percent: int = 85,
    bands: int = 25,
    rows: int = 4,
    small_bucket: int = 2000,
    slice_bytes: int = 2 << 20,
) -> DataFrame:
    """One row per document: n_shingles, component_id (the smallest doc_id reachable) and kept.

    Two documents are linked when 100 * |intersection| >= percent * |union| of their distinct shingles of
    ``words`` words; a text of fewer words is one shingle, one without words has none and is linked with
    nothing. The default bands miss a pair at the threshold with probability 1e-8; every link is verified
    on the full sets. Documents of equal sets form one class from the start, so copies cost one row each.

    Buckets that hold several components after the first verification are searched in full. Up to
    ``small_bucket`` members are compared with each other by bitmaps inside the join, which bounds the
    comparisons of a member and lets few pairs out; larger buckets go to the exact prefix-filtered join, so
    no bucket is capped.

    A null text counts as empty. Rows without doc_id are returned with a null component and ``kept`` true:
    they have no name to be linked by. Rows that share a doc_id count as one document. Further columns
    are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    sketch = stage_table(_sketch(docs, words, bands, rows, slice_bytes), "sketch")
    named = sketch.where("doc_id is not null and set_key is not null")
    first = F.min_by(F.struct("n_shingles", "bands", "bits"), "doc_id").alias("first")
    classes = named.groupBy("set_key").agg(F.min("doc_id").alias("class_id"), first)
    classes = stage_table(classes.select("set_key", "class_id", "first.*"), "classes")
    member = classes.select("class_id", "set_key", "n_shingles", F.explode("bands").alias("band"))
    hub = F.min(F.struct("class_id", "set_key", "n_shingles")).alias("hub")
    shared = stage_table(member.groupBy("band").agg(hub, F.count("*").alias("members")).where("members > 1"), "buckets")
    member = stage_table(member.join(shared, "band"), "members")
    bits = classes.select("set_key", "bits")
    tried = (
        member.where(F.col("set_key") != F.col("hub.set_key"))
        .where(_fits(F.col("n_shingles"), F.col("hub.n_shingles"), percent))
        .selectExpr("class_id a", "set_key a_key", "n_shingles", "hub.class_id b", "hub.set_key b_key", "hub.n_shingles n_shingles_2")
        .distinct()
        .join(bits.toDF("a_key", "bits"), "a_key")
        .join(bits.toDF("b_key", "bits_2"), "b_key")
    )
    tried = stage_table(tried.where(_near(percent)).select("a", "a_key", "b", "b_key"), "pairs")
    found = components(_verify(tried, docs, words, percent, slice_bytes))
    member = member.drop("hub").join(found.withColumnRenamed("node", "class_id"), "class_id", "left")
    member = stage_table(member.withColumn("component", F.coalesce("component", "class_id")), "members")
    mixed = member.groupBy("band").agg(F.min("component").alias("one"), F.max("component").alias("other")).where("one < other").select("band")
    member = stage_table(member.join(mixed, "band").join(bits, "set_key"), "mixed")
    pairs = None
    for few in (True, False):
        part = member.where(F.col("members") <= small_bucket if few else F.col("members") > small_bucket)
        part = _within_buckets(part, percent) if few else _by_prefix(part, docs, words, percent, slice_bytes)
        part = part.where(_fits(F.col("n_shingles"), F.col("n_shingles_2"), percent)).selectExpr("class_id a", "set_key a_key", "class_id_2 b", "set_key_2 b_key")
        pairs = part if pairs is None else pairs.unionByName(part)
    more = _verify(pairs.distinct().join(tried, ["a_key", "b_key"], "left_anti"), docs, words, percent, slice_bytes)
    found = stage_table(found, "found")
    joined = more.join(found.toDF("a", "a_c"), "a", "left").join(found.toDF("b", "b_c"), "b", "left")
    merged = components(joined.select(F.coalesce("a_c", "a").alias("a"), F.coalesce("b_c", "b").alias("b")))
    # component of a class: that of its own component, where further links merged it
    label = classes.select("set_key", "class_id").join(found.toDF("class_id", "c"), "class_id", "left")
    label = label.withColumn("c", F.coalesce("c", "class_id")).join(merged.toDF("c", "m"), "c", "left")
    label = label.select("set_key", F.coalesce("m", "c").alias("component_id"))
    out = sketch.select("doc_id", "n_shingles", "set_key").join(label, "set_key", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    out = out.select("doc_id", "n_shingles", own.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each linked group: the one of the smallest doc_id.

    Rows without doc_id stay. Of rows that repeat a kept doc_id all stay, as they are one document.
    """
    gone = link_near_duplicates(docs, **options).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti")
