"""Benchmark decontamination with suffix arrays over shards of the training documents.

Each task cuts its documents into shards, turns their words into ids of the benchmark's vocabulary
(0: a word no test item has) and sorts the word suffixes that can start a match, as far as a window of
words tells them apart. Every test suffix is then binary-searched in each shard; finds that go on from
one another in both texts make up a verbatim match of full length. Only the benchmark is shipped to the
tasks; documents are read once and never shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import slices

#: A word is a run of ASCII digits and letters, lower-cased, and of anything beyond ASCII.
_FOLD = bytes(
    c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20
    for c in range(256)
)
RESULT = (
    "n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, "
    "longest_match bigint, longest_start bigint, longest_item string"
)


def fold_words(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD)


def words_of(text: str | None) -> list[bytes]:
    return fold_words(text).split()


class TestBlock:
    """The windows of some test items: distinct word runs, their items, and where in the items they stand."""

    __test__ = False

    def __init__(self, items: list[tuple[int, str | None]], window: int):
        self.window, self.vocabulary = window, {}
        grams: dict[tuple[int, ...], int] = {}
        owners: list[set[str]] = []
        places: list[list[int]] = []  # in the row of all items, with a gap after each
        begins, end = [], 0
        self.names = []
        for item_id, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            if item_id is None or not ids:
                continue
            begins.append(end)
            self.names.append(str(item_id))
            for i in range(max(1, len(ids) - window + 1)):
                g = grams.setdefault(tuple(ids[i : i + window]), len(grams))
                if g == len(owners):
                    owners.append(set())
                    places.append([])
                owners[g].add(str(item_id))
                places[g].append(end + i)
            end += len(ids) + 1
        self.begins = np.array(begins, np.int64)
        self.owners = [sorted(x) for x in owners]
        self.place_ends = np.cumsum([0, *map(len, places)])
        self.places = np.array([x for p in places for x in p], np.int64)
        self.lengths = np.array([len(g) for g in grams], np.int64)
        padded = np.zeros((len(grams), window), ">i4")
        for row, gram in zip(padded, grams):
            row[: len(gram)] = gram
        self.low = padded.view(f"S{4 * window}").ravel()
        top = padded.copy().view(np.uint8).reshape(len(grams), 4 * window)
        top[np.arange(4 * window)[None, :] >= 4 * self.lengths[:, None]] = 0xFF
        self.high = top.view(f"S{4 * window}").ravel()
        size = len(self.vocabulary) + 1
        self.pairs = np.unique([g[0] * size + g[1] for g in grams if len(g) > 1]).astype(np.int64)
        self.singles = np.zeros(size, bool)
        self.singles[[g[0] for g in grams if len(g) == 1]] = True

    def search(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, window number) of all occurrences in ``ids``, which ends with ``window`` zeros."""
        none = np.zeros(0, np.int64)
        if not len(self.lengths):
            return none, none
        first, second = ids[:-1].astype(np.int64), ids[1:]
        key = first * (len(self.vocabulary) + 1) + second
        both = np.flatnonzero((first > 0) & (second > 0))
        starts = both[_member(key[both], self.pairs)]
        if self.singles.any():
            starts = np.union1d(starts, np.flatnonzero(self.singles[first]))
        if not len(starts):
            return none, none
        suffixes = ids.astype(">i4")[starts[:, None] + np.arange(self.window)]
        suffixes = np.ascontiguousarray(suffixes).view(f"S{4 * self.window}").ravel()
        order = np.argsort(suffixes, kind="stable")  # the shard's suffix array, to the depth of a window
        suffixes = suffixes[order]
        begin = np.searchsorted(suffixes, self.low, "left")
        count = np.searchsorted(suffixes, self.high, "right") - begin
        gram = np.repeat(np.arange(len(count)), count)
        at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(begin, count)
        return starts[order[at]], gram


    def matches(self, at: np.ndarray, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position, length, item number) of all maximal verbatim matches, from the windows' occurrences.

        An occurrence goes on where the next word starts one too and the test item's next word does: the same
        difference of places, the next position.
        """
        n = self.place_ends[gram + 1] - self.place_ends[gram]
        own = np.repeat(np.arange(len(at)), n)
        place = self.places[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.place_ends[gram], n)]
        apart = place - at[own]
        order = np.lexsort((at[own], apart))
        own, apart, place = own[order], apart[order], place[order]
        heads = np.flatnonzero(np.concatenate([[True], (np.diff(apart) != 0) | (np.diff(at[own]) != 1)]))
        runs = np.diff(np.concatenate([heads, [len(own)]]))
        first = own[heads]
        return at[first], runs - 1 + self.lengths[gram[first]], np.searchsorted(self.begins, place[heads], "right") - 1


def _member(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return table[at] == values


def _judge(texts: list[str | None], blocks: list, threshold: int) -> dict[str, list]:
    words = [words_of(t) for t in texts]
    n_words = np.array([len(w) for w in words], np.int64)
    n_docs, out = len(words), {}
    ends = np.cumsum(n_words + 1)  # a zero after each document keeps matches inside it
    begins = ends - n_words - 1
    covered = np.zeros(ends[-1] + 1 if n_docs else 1, np.int32)
    found: list[set[str]] = [set() for _ in range(n_docs)]
    longest: list[tuple[int, int, str] | None] = [None] * n_docs  # (-length, start, item)
    for broadcast in blocks:
        block = broadcast.value
        ids = np.zeros(ends[-1] + block.window, np.int32)
        known = block.vocabulary.get
        for own, begin in zip(words, begins):
            ids[begin : begin + len(own)] = [known(w, 0) for w in own]
        at, gram = block.search(ids)
        if not len(at):
            continue
        np.add.at(covered, at, 1)
        np.add.at(covered, at + block.lengths[gram], -1)
        doc = np.searchsorted(ends, at, "right")
        for pair in np.unique(doc * len(block.lengths) + gram).tolist():
            d, g = divmod(pair, len(block.lengths))
            found[d].update(block.owners[g])
        start, length, item = block.matches(at, gram)
        for d, p, n, i in zip(np.searchsorted(ends, start, "right").tolist(), start.tolist(), length.tolist(), item.tolist()):
            best = (-n, p - int(begins[d]), block.names[i])
            if longest[d] is None or best < longest[d]:
                longest[d] = best
    hit = np.cumsum(covered[:-1]) > 0
    total = np.concatenate([[0], np.cumsum(hit)])
    n_hit = total[ends - 1] - total[begins]
    out["n_words"], out["n_hit"], out["n_items"] = n_words, n_hit, [len(x) for x in found]
    out["items_sha256"] = [hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in found]
    out["contaminated"] = (n_hit > 0) & (threshold * n_hit >= n_words)
    out["longest_match"] = [0 if x is None else -x[0] for x in longest]
    out["longest_start"], out["longest_item"] = ([None if x is None else x[i] for x in longest] for i in (1, 2))
    return out


def match_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 13,
    threshold: int = 20,
    block_bytes: int = 16 << 20,
    shard_bytes: int = 4 << 20,
) -> DataFrame:
    """One row per document: words, words inside verbatim test passages, and the test items found.

    A test item is cut into all runs of ``window`` words (a shorter item is one run). A document is
    contaminated when at least one in ``threshold`` of its words is hit. ``longest_match``,
    ``longest_start`` and ``longest_item`` give the longest verbatim match with one item in words, the word
    it starts at and the item; of equals the first in the text, then the least item_id as a string. Matches
    shorter than a window are none, but for whole items: then the length is 0, place and item are null.

    The benchmark is sized first and shipped in blocks of about ``block_bytes``, each built and sent on its
    own; a worker keeps the blocks it has seen, so its memory grows with the benchmark, never with the
    documents. A null or empty text has no
    words: it is never contaminated. Items without id, text or words match nothing. Rows that repeat a
    doc_id are judged separately. Any further columns of either table are ignored.
    """
    spark = docs.sparkSession
    items = benchmark.select("item_id", "text")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, -(-total // block_bytes))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks))
    blocks = [
        spark.sparkContext.broadcast(TestBlock([tuple(r) for r in items.where(part == i).collect()], window))
        for i in range(n_blocks)
    ]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col, shard_bytes):
            found = _judge(batch.column(text_col).to_pylist(), blocks, threshold)
            columns = [pa.array(x, {"longest_start": pa.int64(), "longest_item": pa.string()}.get(k)) for k, x in found.items()]
            yield pa.RecordBatch.from_arrays([batch.column(id_col), *columns], [id_col, *found])

    id_type = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(judge, f"`{id_col}` {id_type}, {RESULT}")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without its contaminated rows; all columns stay, and rows with a null id are judged like others.

    The verdict is computed beside the whole row, in one pass without a join.
    """
    id_col, text_col = "__row", options.pop("text_col", "text")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    judged = match_benchmark(
        docs.select(whole.alias(id_col), F.col(f"`{text_col}`").alias("__text")), benchmark, id_col=id_col, text_col="__text", **options
    )
    return judged.where(~F.col("contaminated")).select(f"{id_col}.*")
