"""Importance resampling of a corpus towards the word-run distribution of a target.

A document's features are its runs of one to ``n`` consecutive words, hashed to buckets. The log ratio of a
bucket's share in the target and in the corpus is its gain; a document's weight is the mean gain of its
features, and Gumbel noise on the weights draws a sample without replacement. Long texts are cut into
chunks at word boundaries: a chunk owns the runs that start in it and carries the ``n - 1`` words after it
to finish them, so counts and gains of chunks add up to those of the whole text. Chunks are dealt out
evenly; short texts are worked on where they are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import parallelism, slices, stage_table
from gridloom.llm.decontamination import fold_words, words_of


def chunks(folded: bytes, n: int, most: int) -> Iterator[tuple[bytes, bytes]]:
    """Cut folded words into (own, carried): own parts of about ``most`` bytes, and the ``n - 1`` words after each."""
    start = 0
    while start < len(folded):
        cut = folded.find(b" ", start + most)
        cut = len(folded) if cut < 0 else cut
        carried, at = [], cut
        while len(carried) < n - 1 and at < len(folded):
            end = folded.find(b" ", at + 1)
            end = len(folded) if end < 0 else end
            carried += folded[at:end].split()
            at = end
        yield folded[start:cut], b" ".join(carried)
        start = cut


def buckets_of(own: list[bytes], carried: list[bytes], n: int, buckets: int) -> np.ndarray:
    """Buckets of all runs of 1 to ``n`` words that start in ``own``; a longer run's checksum goes on from the shorter one's."""
    spaced = [b" " + w for w in chain(own, carried)]
    runs = list(map(crc32, own))
    found = [runs]
    for k in range(1, n):
        runs = list(map(crc32, spaced[k:], runs))
        found.append(runs)
    return np.fromiter(chain.from_iterable(found), np.int64, sum(map(len, found))) % buckets


def _parts(docs: DataFrame, n: int, chunk_bytes: int) -> tuple[DataFrame, DataFrame]:
    """(row, doc_id, text) of short texts, and (row, doc_id, own, carried) of the long ones' chunks, dealt out anew."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    length = F.coalesce(F.octet_length("text"), F.lit(0))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", chunk_bytes):
            for row, doc, text in zip(*(batch.column(i).to_pylist() for i in range(2)), batch.column(2)):
                for own, carried in chunks(fold_words(text.as_py()), n, chunk_bytes):
                    yield pa.RecordBatch.from_arrays([pa.array([row], pa.int64()), pa.array([doc], batch.column(1).type), pa.array([own], pa.binary()), pa.array([carried], pa.binary())], ["row", "doc_id", "own", "carried"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    long = rows.where(length > chunk_bytes).mapInArrow(cut, f"row bigint, doc_id {kind}, own binary, carried binary")
    return rows.where(length <= chunk_bytes), long.repartition(parallelism(docs.sparkSession))


def _words(batch: pa.RecordBatch) -> Iterator[tuple[list[bytes], list[bytes]]]:
    if "own" in batch.schema.names:
        for own, carried in zip(batch.column("own").to_pylist(), batch.column("carried").to_pylist()):
            yield own.split(), carried.split()
    else:
        for text in batch.column("text").to_pylist():
            yield words_of(text), []


def bucket_counts(docs: DataFrame, *, n: int = 2, buckets: int = 10_000, chunk_bytes: int = 1 << 16, slice_bytes: int = 4 << 20) -> np.ndarray:
    """How many features of all texts fall in each bucket. Each task sends one row a bucket, whatever it reads."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, column = np.zeros(buckets, np.int64), None
        for whole in batches:
            column = "own" if "own" in whole.schema.names else "text"
            for batch in slices([whole], column, slice_bytes):
                for own, carried in _words(batch):
                    total += np.bincount(buckets_of(own, carried, n, buckets), minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    short, long = _parts(docs, n, chunk_bytes)
    found = short.select("text").mapInArrow(count, "bucket bigint, n bigint").union(long.select("own", "carried").mapInArrow(count, "bucket bigint, n bigint"))
    total = np.zeros(buckets, np.int64)
    for row in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most ``buckets`` rows
        total[row.bucket] = row.n
    return total


def gains_of(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln((t + 1) * (S + B) / ((s + 1) * (T + B)))) of each of B buckets."""
    b = len(corpus)
    all_s, all_t = float(corpus.sum() + b), float(target.sum() + b)
    return np.array([math.floor(1000 * math.log((t + 1) * all_s / ((s + 1) * all_t))) for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def weigh(docs: DataFrame, gains: np.ndarray, *, n: int = 2, chunk_bytes: int = 1 << 16, slice_bytes: int = 4 << 20) -> DataFrame:
    """doc_id, n_words, n_features and weight (floored mean of gains; 0 without words) of every row."""

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            column = "own" if "own" in whole.schema.names else "text"
            for batch in slices([whole], column, slice_bytes):
                words, features, sums = [], [], []
                for own, carried in _words(batch):
                    found = buckets_of(own, carried, n, len(gains))
                    words.append(len(own))
                    features.append(len(found))
                    sums.append(int(gains[found].sum()))
                yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (words, features, sums))], ["row", "doc_id", "n_words", "n_features", "gain"])

    kind = f"row bigint, doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words bigint, n_features bigint, gain bigint"
    short, long = (part.mapInArrow(total, kind) for part in _parts(docs, n, chunk_bytes))
    summed = long.groupBy("row", "doc_id").agg(*[F.sum(c).alias(c) for c in ("n_words", "n_features", "gain")])
    mean = F.expr("case when n_features = 0 then 0 else (gain - pmod(gain, n_features)) div n_features end")
    return short.union(summed).select("doc_id", "n_words", "n_features", mean.alias("weight"))


def drawn_ranks(scored: DataFrame, eligible, percent: int) -> DataFrame:
    """Add ``rank``: 1, 2, 3... for the ``percent`` per cent of eligible rows with the highest scores, else null.

    Rows are ordered in ranges whose ranks start after those of the ranges before, so no task sees them
    all. Rows that tie in score and doc_id are taken as read.
    """
    spark = scored.sparkSession
    kept = stage_table(scored.withColumn("__eligible", eligible).withColumn("__tie", F.monotonically_increasing_id()), "scored")
    order = [F.desc("score"), F.asc("doc_id"), F.asc("__tie")]
    chosen = kept.where("__eligible").repartitionByRange(parallelism(spark), *order).withColumn("__range", F.spark_partition_id())
    ranged = stage_table(chosen, "ranged")
    sizes = {r["__range"]: r["count"] for r in ranged.groupBy("__range").count().collect()}  # one row a range
    starts, at = [], 0
    for k in range(max(sizes, default=-1) + 1):
        starts.append(at)
        at += sizes.get(k, 0)
    first = F.element_at(F.array(*[F.lit(x).cast("bigint") for x in starts or [0]]), F.col("__range") + 1)
    rank = F.row_number().over(Window.partitionBy("__range").orderBy(*order)) + first
    ranked = ranged.withColumn("rank", F.when(rank <= at * percent // 100, rank)).drop("__range")
    rest = kept.where("not __eligible").withColumn("rank", F.lit(None).cast("bigint"))
    return ranked.unionByName(rest).drop("__eligible", "__tie")


def resample(docs: DataFrame, target: DataFrame, *, n: int = 2, buckets: int = 10_000, least_words: int = 20, percent: int = 25, seed: int = 7, chunk_bytes: int = 1 << 16) -> DataFrame:
    """doc_id, n_features, weight, score, rank and n_words of every row of ``docs``.

    Null and empty texts have no features and weight 0. Documents of at least ``least_words`` words are drawn
    from; those not drawn, or too short, have a null rank. A null doc_id draws by the empty id. Rows that
    repeat an id draw the same noise and are ranked one by one, in no order among full ties. An empty table
    gives an empty result; an empty target gives the corpus's own buckets less weight. Further columns are
    ignored. ``docs`` should be read from files or a staged table, as rows are numbered where they are read.
    """
    gains = gains_of(bucket_counts(docs, n=n, buckets=buckets, chunk_bytes=chunk_bytes), bucket_counts(target.select(F.lit(None).cast("string").alias("doc_id"), "text"), n=n, buckets=buckets, chunk_bytes=chunk_bytes))
    weighed = weigh(docs, gains, n=n, chunk_bytes=chunk_bytes)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = weighed.withColumn("score", F.col("weight") + noise)
    return drawn_ranks(scored, F.col("n_words") >= least_words, percent).select("doc_id", "n_features", "weight", "score", "rank", "n_words")
