"""Hard negatives for contrastive training, by exact integer products of bit-sliced vectors.

Vectors become integers. A candidate's components are read one bit-plane after another, the most
significant first: after some planes its product with an anchor is known up to an interval, which each
further plane halves. Candidates whose interval can no longer reach a place among the best, or meet the
range of scores that counts as hard, are dropped; those left after the last plane have exact scores.

Anchors go to the tasks in blocks of bounded size; each block meets all rows where they are read, and only
a few best rows for each anchor leave a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import stage_all, stage_table

#: Components beyond this, or longer vectors, would leave the 53 bits in which doubles count exactly.
MOST_COMPONENT, MOST_LENGTH = 1 << 20, 4096


def integer_rows(table: DataFrame, *, scale: int = 256, relabel_every: int = 7, labels: int = 10) -> DataFrame:
    """vec_id, label (moved on by one where vec_id is divisible by ``relabel_every``) and ``v``, the integer vector, of rows that take part."""
    x = F.transform("embedding", lambda c: F.floor(c.cast("double") * scale))
    sound = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < MOST_COMPONENT / scale))
    known = table.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") <= MOST_LENGTH) & sound)
    label = F.when(F.col("vec_id") % relabel_every == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    return known.select(F.col("vec_id").cast("bigint").alias("vec_id"), label.cast("bigint").alias("label"), F.transform(x, lambda c: c.cast("int")).alias("v"))


def _matrix(column: pa.ListArray, width: int = 0) -> np.ndarray:
    """One row a vector; shorter vectors are filled up with zeros."""
    starts, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False).astype(np.int64)
    lengths = np.diff(starts)
    out = np.zeros((len(lengths), max(width, int(lengths.max(initial=0)))), np.int64)
    at = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[np.repeat(np.arange(len(lengths)), lengths), at] = flat[starts[0] : starts[-1]]
    return out


@dataclass
class Anchors:
    """A block of anchors: their row numbers, ids, labels and vectors, and the score ranges looked for in each."""

    row: np.ndarray
    vec_id: np.ndarray
    label: np.ndarray
    vectors: np.ndarray

    def widened(self, width: int) -> np.ndarray:
        return np.pad(self.vectors, ((0, 0), (0, max(0, width - self.vectors.shape[1])))).astype(np.float64)


def sliced_scores(anchors: np.ndarray, candidates: np.ndarray, allowed: np.ndarray, can_qualify) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, candidate and exact product of every allowed pair that ``can_qualify(anchor, low, high)`` never turned down.

    ``can_qualify`` gets arrays of anchor numbers and of bounds, both included, for a number of pairs.
    """
    least = int(candidates.min(initial=0))
    rest = candidates - least  # bit-planes of numbers from 0 on
    width = int(rest.max(initial=0)).bit_length()
    below, above = np.minimum(anchors, 0).sum(1), np.maximum(anchors, 0).sum(1)
    partial = np.repeat((anchors.sum(1) * least)[:, None], len(candidates), 1)
    a, c = (), ()
    dense = True
    for bit in range(width - 1, -1, -1):
        plane = ((rest >> bit) & 1).astype(np.float64)
        if dense:
            partial += (anchors @ plane.T) * float(1 << bit)
        else:
            for at in range(0, len(a), 1 << 16):  # vectors of so many pairs at a time
                part = slice(at, at + (1 << 16))
                known[part] += np.einsum("ij,ij->i", anchors[a[part]], plane[c[part]]) * float(1 << bit)
        left = float((1 << bit) - 1)
        if dense:
            if left * float((above - below).max(initial=0)) > 4 * float(np.abs(partial).max(initial=0)) + 1:
                continue  # intervals are still wider than all scores
            every = np.arange(len(anchors))[:, None]
            kept = allowed & can_qualify(every, partial + (left * below)[:, None], partial + (left * above)[:, None])
            if bit and np.count_nonzero(kept) * 8 > kept.size:
                continue
            a, c = np.nonzero(kept)
            known, dense = partial[a, c], False
        else:
            kept = can_qualify(a, known + left * below[a], known + left * above[a])
            a, c, known = a[kept], c[kept], known[kept]
    if dense:  # no bit-plane at all, or never sifted
        a, c = np.nonzero(allowed & can_qualify(np.arange(len(anchors))[:, None], partial, partial))
        known = partial[a, c]
    return a, c, known.astype(np.int64)


def best(group: np.ndarray, score: np.ndarray, vec_id: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` of each group by score downwards, then vec_id."""
    order = np.lexsort((vec_id, -score, group))
    own = group[order]
    first = np.searchsorted(own, own, "left")
    return order[np.arange(len(own)) - first < k]


class _Running:
    """The best ``k`` pairs of each group so far, and the score that a pair has to reach."""

    def __init__(self, groups: int, k: int):
        self.k = k
        self.group = self.score = self.vec_id = np.zeros(0, np.int64)
        self.bar = np.full(groups, -np.inf)

    def add(self, group: np.ndarray, score: np.ndarray, vec_id: np.ndarray) -> None:
        both = [np.concatenate(x) for x in ((self.group, group), (self.score, score), (self.vec_id, vec_id))]
        at = best(*both, self.k)
        self.group, self.score, self.vec_id = (x[at] for x in both)
        full = np.flatnonzero(np.bincount(self.group, minlength=len(self.bar)) == self.k)
        last = np.searchsorted(self.group, full, "right") - 1
        self.bar[full] = self.score[last]


def _batches(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for whole in batches:
        for at in range(0, len(whole), rows):
            batch = whole.slice(at, rows)
            yield batch.column("vec_id").to_numpy(), batch.column("label").to_numpy(), _matrix(batch.column("v"))


def _first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The first ``k`` rows of each key, of what the tasks have sent; ``rank`` counts from 1."""
    window = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def positives_of(rows: DataFrame, block: Anchors, *, k: int, batch_rows: int = 2048) -> DataFrame:
    """anchor (its place in the block), vec_id, score, rank: the first ``k`` other rows of each anchor's label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = _Running(len(block.row), k)
        for vec_id, label, v in _batches(batches, batch_rows):
            anchors = block.widened(v.shape[1])
            for kind in np.unique(label):
                mine, theirs = np.flatnonzero(block.label == kind), np.flatnonzero(label == kind)
                if len(mine):
                    other = block.vec_id[mine][:, None] != vec_id[theirs][None, :]
                    a, c, score = sliced_scores(anchors[mine], np.pad(v[theirs], ((0, 0), (0, anchors.shape[1] - v.shape[1]))), other, lambda i, low, high: high >= top.bar[mine[i]])
                    top.add(mine[a], score, vec_id[theirs[c]])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (top.group, top.vec_id, top.score)], ["anchor", "vec_id", "score"])

    return _first(rows.mapInArrow(run, "anchor bigint, vec_id bigint, score bigint"), ["anchor"], k)


def negatives_of(rows: DataFrame, block: Anchors, positive: np.ndarray, *, k: int, low: int, high: int, batch_rows: int = 2048) -> DataFrame:
    """anchor, place (of the positive), vec_id, score, rank: the first ``k`` rows of other labels whose score is in range.

    ``positive`` holds (anchor, place) scores, NaN where an anchor has fewer. In range is
    low * positive <= 100 * score <= high * positive.
    """
    places = positive.shape[1]
    with np.errstate(invalid="ignore"):
        floor = np.where(np.isnan(positive), np.inf, np.ceil(low * positive / 100))
        ceiling = np.where(np.isnan(positive), -np.inf, np.floor(high * positive / 100))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = _Running(len(block.row) * places, k)
        for vec_id, label, v in _batches(batches, batch_rows):
            bar = np.maximum(floor, top.bar.reshape(-1, places))
            open_to = bar <= ceiling
            outer_low = np.where(open_to, bar, np.inf).min(1, initial=np.inf)
            outer_high = np.where(open_to, ceiling, -np.inf).max(1, initial=-np.inf)

            def can_qualify(i, least, most):
                meets = (most >= outer_low[i]) & (least <= outer_high[i])
                if i.ndim == 1:  # few pairs by now: against every range by itself
                    meets &= ((most[:, None] >= bar[i]) & (least[:, None] <= ceiling[i])).any(1)
                return meets

            anchors = block.widened(v.shape[1])
            other = (block.label[:, None] != label[None, :]) & (block.vec_id[:, None] != vec_id[None, :])
            a, c, score = sliced_scores(anchors, np.pad(v, ((0, 0), (0, anchors.shape[1] - v.shape[1]))), other, can_qualify)
            pair, place = np.nonzero((score[:, None] >= floor[a]) & (score[:, None] <= ceiling[a]))
            top.add(a[pair] * places + place, score[pair], vec_id[c[pair]])
        anchor, place = np.divmod(top.group, places)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (anchor, place, top.vec_id, top.score)], ["anchor", "place", "vec_id", "score"])

    return _first(rows.mapInArrow(run, "anchor bigint, place bigint, vec_id bigint, score bigint"), ["anchor", "place"], k)


def mine_hard_negatives(table: DataFrame, *, anchor_every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, block_rows: int = 2048) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are rows whose vec_id is divisible by ``anchor_every``; blocks hold ``block_rows`` of them, so
    memory is bounded whatever their number. Rows with a null vec_id, label, vector or component, with a
    component that is not finite or from 4096 on in size, or with over 4096 components take no part (beyond
    that, products would leave the exact range of doubles). Missing components of shorter vectors count as 0;
    an empty vector scores 0. Each row that repeats a vec_id counts by itself, and is never its own id's
    positive or negative. Anchors without positives, positives without negatives and empty tables give no
    rows. Further columns are ignored.
    """
    rows = integer_rows(table)
    staged = stage_table(rows.where(F.col("vec_id") % anchor_every == 0).withColumn("row", F.monotonically_increasing_id()), "anchors")

    def blocks() -> Iterator[DataFrame]:
        last = -1
        while True:
            got = staged.where(F.col("row") > last).orderBy("row").limit(block_rows).toArrow()
            if len(got):
                last = int(got["row"][-1].as_py())
                yield one(got.combine_chunks())
            if len(got) < block_rows:
                return

    def one(got: pa.Table) -> DataFrame:
        column = {c: got[c].to_numpy() for c in ("row", "vec_id", "label")}
        block = Anchors(column["row"], column["vec_id"], column["label"], _matrix(got["v"].chunk(0)))
        found = positives_of(rows, block, k=positives).toArrow()  # ``positives`` rows an anchor at most
        anchor, place = found["anchor"].to_numpy(), found["rank"].to_numpy() - 1
        ids, scores = np.zeros((len(block.row), positives), np.int64), np.full((len(block.row), positives), np.nan)
        ids[anchor, place], scores[anchor, place] = found["vec_id"].to_numpy(), found["score"].to_numpy()
        at = np.stack([anchor, place], 1)
        names = pa.table({"anchor": at[:, 0].astype(np.int64), "place": at[:, 1].astype(np.int64), "anchor_id": block.vec_id[anchor], "positive_id": ids[anchor, place], "positive_score": scores[anchor, place].astype(np.int64)})
        hard = negatives_of(rows, block, scores, k=negatives, low=low, high=high)
        joined = hard.join(F.broadcast(table.sparkSession.createDataFrame(names)), ["anchor", "place"])  # positives * block_rows rows at most
        return joined.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))

    empty = table.sparkSession.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")
    return stage_all(blocks(), empty, "hard_negatives")
