"""Removal of repeated passages by sliding spans of sentences and by windows of words.

Every run of consecutive sentences is hashed where its document is read. Runs met more than once are
joined back to their places, and each sentence that such a run covers is removed, unless the run is its
first occurrence in the corpus. Hashes with one occurrence, nearly all, leave after one counting shuffle.

Passages that no whole sentences bound are found by windows of ``passage_words`` words, which take one row
a word if each is written. They are written in blocks instead: neighbouring windows with the same least
word gram (by hash). Equal windows have equal grams, so a gram met once has no repeated window, and where all
blocks of a gram are equal so are their windows, one by one; only the other grams' blocks are taken apart.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (reached as pa.compute)
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import discard, slices, stage_table
from gridloom.llm.near_duplicates import mix64

#: A sentence with the punctuation and white space that end it; joined, the pieces are the text.
_END = re.compile(r"[.!?]+\s+|\n\s*")
_WORD = re.compile(r"[^\W_]+")
_TAIL = re.compile(r"[^\w\s]*\s*")
_LAST = -(1 << 63)


def sentences(text: str) -> list[str]:
    """The pieces of a text, each with what ends it."""
    cuts = [0, *(m.end() for m in _END.finditer(text)), len(text)]
    return [text[a:b] for a, b in zip(cuts, cuts[1:]) if b > a]


def words_of(text: str) -> list[list[str]]:
    """The words of each sentence, in lower case."""
    return [_WORD.findall(s.lower()) for s in sentences(text)]


def spans(words: list[list[str]], span: int, least_words: int) -> list[tuple[int, int, int]]:
    """(first sentence, end, hash) of the run from each sentence on; runs that reach past the end are left out.

    A run compares its words, in lower case and without punctuation; it has ``span`` sentences with words
    at least and goes on until it has ``least_words`` words.
    """
    full = [i for i, w in enumerate(words) if w]
    lengths = np.cumsum([0] + [len(words[i]) for i in full])
    ends = np.maximum(np.arange(len(full)) + span, np.searchsorted(lengths, lengths[:-1] + least_words))
    texts = [" ".join(words[i]) for i in full]
    out = []
    for i, j in enumerate(ends.tolist()):
        if j <= len(full):
            h = xxhash.xxh3_64_intdigest(" ".join(texts[i:j]))
            out.append((full[i], full[j - 1] + 1, h - (1 << 64) if h >> 63 else h))
    return out


class WordHashes(dict):
    """64-bit hashes of words, kept from text to text."""

    def __missing__(self, word: str) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, texts: list[list[list[str]]]) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of all words of the texts, and the place at which each text begins."""
        if len(self) > 1_000_000:
            self.clear()
        sizes = [sum(map(len, t)) for t in texts]
        words = chain.from_iterable(chain.from_iterable(texts))
        return np.fromiter(map(self.__getitem__, words), np.uint64, sum(sizes)), np.cumsum([0, *sizes])


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of the ``size`` words from each word on, put together from windows of powers of two."""
    if len(hashes) < size:
        return np.zeros(0, np.uint64)
    n = len(hashes) - size + 1
    out, done, part, length, factor = np.zeros(n, np.uint64), 0, hashes, 1, 0x9E3779B97F4A7C15
    while length <= size:
        if size & length:
            out = out * np.uint64(factor) + part[done : done + n]
            done += length
        part = part[:-length] * np.uint64(factor) + part[length:] if len(part) > length else part[:0]
        factor, length = factor * factor % (1 << 64), 2 * length
    return mix64(out)


def _least(values: np.ndarray, size: int) -> np.ndarray:
    """The place of the least of the ``size`` values from each value on, the leftmost of equal ones."""
    at, length, n = np.arange(len(values)), 1, len(values) - size + 1
    while length < size:
        step = min(length, size - length)
        left, right = at[:-step], at[step:]
        at, length = np.where(values[right] < values[left], right, left), length + step
    return at[:n]


def blocks(hashes: np.ndarray, starts: np.ndarray, passage_words: int) -> np.ndarray:
    """(text, first word, end, gram, block) of each block of windows in texts that begin at ``starts``."""
    size = max(1, 2 * passage_words // 5)
    every = windows(hashes, passage_words)
    if not len(every):
        return np.zeros((0, 5), np.int64)
    grams = windows(hashes, size)
    least = _least(grams, passage_words - size + 1)
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    inside = np.flatnonzero(owner[: len(every)] == owner[passage_words - 1 :])
    least = least[inside]
    edge = np.concatenate([[True], least[1:] != least[:-1]]) if len(least) else np.zeros(0, bool)
    a, b = inside[edge], inside[np.append(edge[1:], True)] if len(least) else inside
    at = least[edge]
    block = mix64(mix64(every[a] ^ (b - a).astype(np.uint64)) + mix64(every[b] + (at - a).astype(np.uint64)) * np.uint64(3))
    return np.column_stack([owner[a], a - starts[owner[a]], b + passage_words - starts[owner[a]], grams[at].view(np.int64), block.view(np.int64)])


_RUNS_SCHEMA = "sid bigint, tid bigint, first bigint, last bigint, hash bigint, block bigint"


def _rows(batch: pa.RecordBatch, text: np.ndarray, columns: list[np.ndarray], block: pa.Array | None = None) -> pa.RecordBatch:
    text = pa.array(text)
    own = [pa.array(np.ascontiguousarray(c)) for c in columns]
    block = pa.nulls(len(text), pa.int64()) if block is None else block
    return pa.RecordBatch.from_arrays([batch.column("sid").take(text), batch.column("tid").take(text), *own, block], ["sid", "tid", "first", "last", "hash", "block"])


def _runs(docs: DataFrame, span: int, least_words: int, passage_words: int, slice_bytes: int) -> DataFrame:
    """Runs of sentences with a null ``block``, and blocks of windows with their gram as ``hash``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in slices(batches, "text", slice_bytes):
            words = [words_of(t or "") for t in batch.column("text").to_pylist()]
            found = [spans(w, span, least_words) for w in words]
            flat = np.array([s for x in found for s in x], np.int64).reshape(-1, 3)
            yield _rows(batch, np.repeat(np.arange(len(found)), [len(x) for x in found]), list(flat.T))
            flat = blocks(*hashes.of(words), passage_words)
            yield _rows(batch, flat[:, 0], list(flat[:, 1:4].T), pa.array(np.ascontiguousarray(flat[:, 4])))

    return docs.mapInArrow(run, _RUNS_SCHEMA)


def _windows_of(docs: DataFrame, passage_words: int, slice_bytes: int) -> DataFrame:
    """The windows of the blocks in column ``blocks`` one by one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in slices(batches, "text", slice_bytes):
            own, starts = hashes.of([words_of(t or "") for t in batch.column("text").to_pylist()])
            every = windows(own, passage_words)
            lists = batch.column("blocks")
            text = np.repeat(np.arange(len(lists)), pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False))
            first, last = (np.asarray(pa.compute.list_flatten(lists).field(i)) for i in (0, 1))
            n = last - first - passage_words + 1
            at = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
            text = np.repeat(text, n)
            yield _rows(batch, text, [at, at + passage_words, every[starts[text] + at].view(np.int64)])

    return docs.mapInArrow(run, _RUNS_SCHEMA)


def _word_places(sentence: str) -> list[tuple[int, int]]:
    """(start, end) in ``sentence`` of the words of its lower case, which may be longer."""
    low = sentence.lower()
    places = [m.span() for m in _WORD.finditer(low)]
    if len(low) == len(sentence):
        return places
    origin = [i for i, c in enumerate(sentence) for _ in c.lower()]
    return [(origin[a], origin[b - 1] + 1) for a, b in places]


def take_out(text: str, of_sentences: list[tuple[int, int]], of_words: list[tuple[int, int]]) -> tuple[str, int, int]:
    """The text without ranges of its sentences and of its words, its sentences, and those that lost something.

    A sentence without any word left goes whole, and so do wordless ones inside a range of words. After
    words taken out of a sentence, what hangs on them and the white space up to the next word go, too.
    """
    pieces = sentences(text)
    drop = np.zeros(len(pieces), bool)
    for a, b in of_sentences:
        drop[a:b] = True
    if not of_words:
        return "".join(p for p, d in zip(pieces, drop) if not d), len(pieces), int(drop.sum())
    places = [_word_places(p) for p in pieces]
    ends = np.cumsum([0] + [len(x) for x in places])
    words, gaps = np.zeros(ends[-1] + 1, np.int64), np.zeros(ends[-1] + 2, np.int64)
    for a, b in of_words:
        words[a] += 1
        words[b] -= 1
        gaps[a + 1] += 1
        gaps[b] -= 1
    words, gaps = np.cumsum(words) > 0, np.cumsum(gaps) > 0  # gaps[i]: between words i - 1 and i
    out, gone = [], 0
    for piece, own, at, dropped in zip(pieces, places, ends, drop):
        cut = words[at : at + len(own)]
        if dropped or (cut.all() if own else gaps[at]):
            gone += 1
        elif not cut.any():
            out.append(piece)
        else:
            gone += 1
            kept = 0
            for j, (a, b) in enumerate(own):
                if not cut[j]:
                    continue
                if j == 0 or not cut[j - 1]:
                    out.append(piece[kept:a])
                kept = b if j + 1 == len(own) else own[j + 1][0] if cut[j + 1] else min(_TAIL.match(piece, b).end(), own[j + 1][0])
            out.append(piece[kept:])
    return "".join(out), len(pieces), gone


def remove_repeated_spans(docs: DataFrame, *, span: int = 2, least_words: int = 20, passage_words: int = 51, slice_bytes: int = 4 << 20) -> DataFrame:
    """doc_id, text, n_sentences, n_removed and removed_chars of every row, with repeated passages taken out.

    A span is a run of ``span`` consecutive sentences, extended sentence by sentence until it has
    ``least_words`` words, so that stock phrases are no passage. All sentences covered by a span that
    occurs earlier (by doc_id, then text hash, then place) are removed; the first occurrence stays whole.
    So are, whatever sentences they lie in, all words of ``passage_words`` consecutive ones that occur
    earlier; ``n_removed`` counts a sentence that loses some of its words like one that goes. A passage
    that repeats within a document is removed there, too; where it overlaps its first occurrence, the
    words beyond that.

    A null text stays null and an empty one empty, both without sentences; a text of one sentence has no
    span, only words. Rows that repeat both doc_id and text count as one document and are all treated
    alike. Null doc_ids come first. Further columns are ignored.
    """
    docs = docs.select(
        "doc_id",
        "text",
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LAST)).alias("sid"),
        F.xxhash64("text").alias("tid"),
    )
    runs = stage_table(_runs(docs.select("sid", "tid", "text"), span, least_words, passage_words, slice_bytes), "runs")
    # written, so that the join that follows is free to split a common run's rows among tasks
    counted = runs.groupBy("hash").agg(F.count("*").alias("n"), F.min("block").alias("low"), F.max("block").alias("high"))
    again = stage_table(counted.where("n > 1").select("hash", F.coalesce(F.expr("low < high"), F.lit(False)).alias("mixed")), "again")
    met = stage_table(runs.join(again, "hash"), "met")
    discard(runs)
    discard(again)
    place = F.struct("sid", "tid", "first")

    def later(runs: DataFrame, name: str) -> DataFrame:
        earliest = stage_table(runs.groupBy("hash").agg(F.min(place).alias("earliest")), name)
        return runs.join(earliest, "hash").where(place != F.col("earliest"))

    apart = met.where("mixed").groupBy("sid", "tid").agg(F.collect_set(F.struct("first", "last")).alias("blocks"))
    apart = docs.select("sid", "tid", "text").join(apart, ["sid", "tid"]).select("sid", "tid", "text", "blocks")
    single = stage_table(_windows_of(apart, passage_words, slice_bytes), "windows")
    whole = met.where("block is not null and not mixed")
    same = (F.col("earliest.sid") == F.col("sid")) & (F.col("earliest.tid") == F.col("tid"))
    beyond = F.when(same, F.greatest("first", F.col("earliest.first") + passage_words)).otherwise(F.col("first"))
    of_words = later(whole, "earliest_blocks").unionByName(later(single, "earliest_windows"), allowMissingColumns=True)
    of_words = of_words.select("sid", "tid", F.lit(True).alias("words"), beyond.alias("first"), "last")
    of_sentences = later(met.where("block is null"), "earliest").select("sid", "tid", F.lit(False).alias("words"), "first", "last")
    covered = of_sentences.unionByName(of_words).groupBy("sid", "tid").agg(F.collect_set(F.struct("words", "first", "last")).alias("covered"))
    joined = docs.join(covered, ["sid", "tid"], "left").select("doc_id", "text", F.coalesce("covered", F.array().cast(covered.schema["covered"].dataType)).alias("covered"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", slice_bytes):
            texts, counts, gone, chars = [], [], [], []
            for text, ranges in zip(batch.column("text").to_pylist(), batch.column("covered").to_pylist()):
                kept, n, lost = take_out(text or "", *([(r["first"], r["last"]) for r in ranges if r["words"] == w] for w in (False, True)))
                texts.append(None if text is None else kept)
                counts.append(n)
                gone.append(lost)
                chars.append(len(text or "") - len(kept))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string()), *(pa.array(x, pa.int64()) for x in (counts, gone, chars))],
                ["doc_id", "text", "n_sentences", "n_removed", "removed_chars"],
            )

    return joined.mapInArrow(cut, f"doc_id {kind}, text string, n_sentences bigint, n_removed bigint, removed_chars bigint")
