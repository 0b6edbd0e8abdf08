"""Language-model scores by a hierarchical Pitman-Yor model of words.

A word's context is the word before it, or the end mark at a text's start. Every context is a restaurant of
its own; all of them share the unigram restaurant as their parent, whose base is uniform over the vocabulary.
Gibbs sweeps remove all customers of one dish from a restaurant and reseat them given everybody else; scores
use predictive probabilities averaged over the sweeps after a burn-in.

All cells (context, word) of one word lie in one bucket, so that tables sent to the parent stay there. A
context's cells lie in many buckets: between sweeps each bucket sends its share of every context's totals to
the context's group, and gets the sums back. Text is cut into slices; a slice's tokens travel once to their
buckets as compressed postings, and the buckets send back one sum per document and bucket. Of the few most
frequent words, whose postings could fill one bucket, the cells are dealt by their contexts; pairs of two
such words keep their postings spread and get a small table of probabilities instead.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import discard, parallelism, slices, stage_table

MOST_HOT = 256
_END = b"\n"
_FIXED = 1 << 30  # log10 values travel as integers of this scale
_CUT = np.uint64(16)  # a context goes by the other 48 bits of its word's hash
_EXACT = 128  # customers of a dish up to which their tables are drawn exactly


@dataclass(frozen=True)
class Strengths:
    """Discounts and concentrations of the context restaurants and of their parent, and the sweeps."""

    discounts: tuple[float, float] = (0.7, 0.75)
    concentrations: tuple[float, float] = (5.0, 10.0)
    burn_in: int = 1
    samples: int = 3
    seed: int = 7


def _pack(*arrays: np.ndarray) -> bytes:
    head = ";".join(f"{a.dtype.str},{len(a)}" for a in arrays).encode()
    raw = len(head).to_bytes(4, "little") + head + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd").compress(raw, asbytes=True)


def _planes(x: np.ndarray) -> np.ndarray:
    """Steps of ascending numbers, byte by byte: their high bytes are few and compress."""
    return np.diff(x, prepend=np.uint64(0)).view(np.uint8).reshape(len(x), 8).T.ravel()


def _from_planes(x: np.ndarray) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(x.reshape(8, -1).T).view(np.uint64).ravel())


def _unpack(blob: bytes) -> list[np.ndarray]:
    raw = pa.Codec("zstd").decompress(blob[8:], int.from_bytes(blob[:8], "little"), asbytes=True)
    at = 4 + int.from_bytes(raw[:4], "little")
    out = []
    for spec in raw[4:at].decode().split(";"):
        kind, n = spec.split(",")
        out.append(np.frombuffer(raw, kind, int(n), at))
        at += out[-1].nbytes
    return out


def tokens(text: str | None) -> list[bytes]:
    """Words with A-Z lower-cased, then one end."""
    return [*(text or "").encode("utf-8", "surrogatepass").lower().split(), _END]


def held_out(doc_id) -> bool:
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 5 == 1


def _hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


def _frequent(docs: DataFrame, buckets: int, slice_bytes: int) -> list[int]:
    """Hashes of the words that make up more than a quarter of a bucket's even share, MOST_HOT at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        total = 0
        for batch in slices(batches, "text", slice_bytes):
            own: Counter = Counter()
            for t in batch.column("text").to_pylist():
                own.update(tokens(t))
            size = sum(own.values())
            total += size
            for w, n in own.items():
                if n * 8 * buckets >= size:
                    seen[_hash(w) - (1 << 63)] += n
        rows = [(None, total), *seen.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], pa.int64()) for j in (0, 1)], ["h", "n"])

    found = docs.select("text").mapInArrow(run, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))
    found = found.orderBy(F.desc_nulls_first(F.when(F.col("h").isNull(), None).otherwise(F.col("n"))), "h").limit(MOST_HOT + 1).collect()
    total = next((r.n for r in found if r.h is None), 0)
    return [r.h + (1 << 63) for r in found if r.h is not None and r.n * 4 * buckets >= total]


def _postings(docs: DataFrame, buckets: int, hot: np.ndarray, slice_bytes: int) -> DataFrame:
    """Rows (kind, bucket, slice, data): d: a slice's documents, p: postings of a bucket's cells,
    h: postings of pairs of frequent words, which stay spread, c: a task's counts of such pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = np.zeros((len(hot), len(hot)), np.int64)
        task, number = TaskContext.get().partitionId(), 0
        spread = lambda s: -1 - s % buckets
        for batch in slices(batches, "text", slice_bytes):
            for part in range(0, batch.num_rows, 60_000):
                own = batch.slice(part, 60_000)
                at = (task << 32) | number
                number += 1
                ids = own.column("doc_id").to_pylist()
                held = np.array([held_out(i) for i in ids], bool)
                rows = [("d", spread(at), at, _pack(np.array([i is None for i in ids]), np.array([i or 0 for i in ids], np.int64), held))]
                h, w, u, d, n = _counted(own.column("text").to_pylist())
                often = np.isin(h, hot)
                ours = ((h >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
                bucket = np.where(~often[w], ours[w], np.where(~often[u], ours[u], buckets))
                order = np.argsort(bucket, kind="stable")
                w, u, d, n, bucket = w[order], u[order], d[order], n[order], bucket[order]
                edges = np.searchsorted(bucket, np.arange(buckets + 2))
                for b in range(buckets):
                    i, j = edges[b], edges[b + 1]
                    if i < j:
                        words, per_word = np.unique(w[i:j], return_counts=True)
                        before, k = np.unique(u[i:j], return_inverse=True)
                        k = k.astype(np.uint16 if len(before) < 1 << 16 else np.uint32)
                        rows.append(("p", b, at, _pack(h[words], per_word.astype(np.uint32), _planes(h[before] >> _CUT), k, d[i:j].astype(np.uint16), n[i:j].astype(np.uint32), held[d[i:j]])))
                i, j = edges[buckets], edges[buckets + 1]
                if i < j:
                    word, before = np.searchsorted(hot, h[w[i:j]]), np.searchsorted(hot, h[u[i:j]])
                    learnt = ~held[d[i:j]]
                    np.add.at(pairs, (word[learnt], before[learnt]), n[i:j][learnt])
                    rows.append(("h", spread(at), at, _pack(word.astype(np.uint16), before.astype(np.uint16), d[i:j].astype(np.uint16), n[i:j].astype(np.uint32))))
                yield _rows(rows)
        yield _rows([("c", buckets + i, 0, _pack(own)) for i, own in enumerate(pairs) if number])

    return docs.select("doc_id", "text").mapInArrow(run, _SCHEMA)


def _counted(texts: list[str | None]) -> tuple[np.ndarray, ...]:
    """Hashes of the distinct words in order, and word, previous word, text and count of each distinct triple."""
    local: defaultdict = defaultdict(count().__next__)
    number_of, sizes, flat = local.__getitem__, [], []
    for t in texts:
        own = tokens(t)
        sizes.append(len(own))
        flat.extend(map(number_of, own))
    h = np.fromiter(map(_hash, local), np.uint64, len(local))
    order = np.argsort(h)
    rank = np.empty(len(h), np.uint64)
    rank[order] = np.arange(len(h), dtype=np.uint64)
    w = rank[np.array(flat, np.int64)]
    u = np.roll(w, 1)
    u[np.cumsum([0, *sizes[:-1]])] = rank[local[_END]]
    high, low = np.uint64(max(1, len(h).bit_length())), np.uint64(len(sizes).bit_length())
    doc = np.repeat(np.arange(len(sizes), dtype=np.uint64), sizes)
    key, n = np.unique((w << (high + low)) | (u << low) | doc, return_counts=True)
    part = lambda x, bits: (x & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    return h[order], (key >> (high + low)).astype(np.int64), part(key >> low, high), part(key, low), n


_SCHEMA = "kind string, bucket bigint, slice bigint, data binary"


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate(kinds)], ["kind", "bucket", "slice", "data"])


_MERGED = "kind string, bucket bigint, slice bigint, cells binary, data binary"


def _merging(hot: np.ndarray, buckets: int):
    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        """One bucket: cells (word, context, learnt count) of all its postings; postings then point at cells."""
        out = [(r.kind, r.bucket, r.slice, None, r.data) for r in rows.itertuples() if r.kind in "dh"]
        posted = [(r.slice, _unpack(r.data)) for r in rows.itertuples() if r.kind == "p"]
        number = int(rows.bucket.iloc[0])
        if posted:
            words, inverse = np.unique(np.concatenate([p[0] for _, p in posted]), return_inverse=True)
            before = [_from_planes(p[2]) for _, p in posted]
            contexts = np.unique(np.concatenate(before))
            keys, at = [], 0
            for (_, p), known in zip(posted, before):
                own = inverse[at : at + len(p[0])]
                at += len(p[0])
                keys.append(np.repeat(own, p[1]).astype(np.int64) * len(contexts) + np.searchsorted(contexts, known)[p[3]])
            cells, where = np.unique(np.concatenate(keys), return_inverse=True)
            n = np.concatenate([p[5] * ~p[6] for _, p in posted])
            learnt = np.bincount(where, n, len(cells)).astype(np.int64)
            packed, at = [], 0
            for (s, p), key in zip(posted, keys):
                own = where[at : at + len(key)].astype(np.int64)
                at += len(key)
                order = np.argsort(own, kind="stable")
                packed += [np.array([s, len(own)], np.int64), np.diff(own[order], prepend=0).astype(np.uint32), p[4][order], p[5][order]]
            out.append(("m", number, 0, _pack(np.diff(cells, prepend=0), learnt, words, _planes(contexts)), _pack(*packed)))
        pairs = [_unpack(r.data)[0] for r in rows.itertuples() if r.kind == "c"]
        if pairs:
            cells = _pack(np.diff(np.arange(len(hot)), prepend=0), sum(pairs), hot[number - buckets : number - buckets + 1], _planes(hot >> _CUT))
            out.append(("c", number, 0, cells, None))
        return pd.DataFrame(out, columns=["kind", "bucket", "slice", "cells", "data"])

    return merge


@lru_cache(4)
def _seatings(discount: float) -> np.ndarray:
    """Logarithms of the weights of seating n customers at t tables (generalised Stirling numbers)."""
    out = np.full((_EXACT + 1, _EXACT + 1), -np.inf)
    out[0, 0] = 0.0
    t = np.arange(_EXACT + 1)
    for n in range(_EXACT):
        with np.errstate(divide="ignore"):
            stay = out[n] + np.log(np.maximum(n - discount * t, 0))
        out[n + 1, 1:] = np.logaddexp(out[n, :-1], stay[1:])
    return out


def reseat(customers: np.ndarray, others: np.ndarray, parent: np.ndarray, discount: float, concentration: float, rng: np.random.Generator) -> np.ndarray:
    """Remove all ``customers`` of each dish and seat them again: the tables that they take.

    ``others`` are the tables of the restaurant's other dishes and ``parent`` the parent's probability of the
    dish. Up to 128 customers the number of tables is drawn from its exact conditional distribution. For more,
    tables are a Poisson number with independent sizes, tilted so that the sizes are expected to add up to the
    customers: a draw from the normal (or, for few tables, shifted Poisson) limit of that.
    """
    tables = np.minimum(customers, 1).astype(np.int64)
    weights = _seatings(discount)
    some = np.flatnonzero((customers > 1) & (customers <= _EXACT))
    some = some[np.argsort(customers[some], kind="stable")]
    sizes, first = np.unique(customers[some], return_index=True)
    for c, i, j in zip(sizes, first, [*first[1:], len(some)]):
        t = np.arange(c)
        for k in range(i, j, max(1, 1_000_000 // c)):
            own = some[k : min(j, k + max(1, 1_000_000 // c))]
            odds = np.log((concentration + discount * (others[own, None] + t)) * parent[own, None])
            odds = np.cumsum(odds, 1) + weights[c, 1 : c + 1]
            odds = np.cumsum(np.exp(odds - odds.max(1, keepdims=True)), 1)
            drawn = (odds < rng.random((len(own), 1)) * odds[:, -1:]).sum(1)
            tables[own] = 1 + np.minimum(drawn, c - 1)
    many = np.flatnonzero(customers > _EXACT)
    if len(many):
        c = customers[many].astype(float)
        mean = np.zeros(len(c))
        for _ in range(2):  # then with half of the dish's own tables among those present
            start = (concentration + discount * (others[many] + mean / 2)) * parent[many]
            lo, hi = np.full(len(c), -60.0), np.full(len(c), 400.0)
            for _ in range(60):
                z = (lo + hi) / 2
                below = np.log(start) - np.logaddexp(0, -z) + (1 - discount) * np.logaddexp(0, z) < np.log(c)
                lo, hi = np.where(below, z, lo), np.where(below, hi, z)
            mean = start * -np.expm1(-discount * np.logaddexp(0, lo)) / discount
        spread = np.maximum(mean - c / (1 + (1 - discount) * np.exp(lo)), 0)
        few = mean < 30
        drawn = 1 + np.where(few, rng.poisson(np.minimum(mean, 30)), np.rint(mean + np.sqrt(spread) * rng.standard_normal(len(c))))
        tables[many] = np.clip(drawn, 1, c)
    return tables


@dataclass
class Root:
    """What the driver knows: sums over the parent restaurant, and its cells of the frequent words."""

    strengths: Strengths
    hot: np.ndarray
    hot_learnt: np.ndarray
    hot_customers: np.ndarray
    hot_tables: np.ndarray
    customers: int
    tables: int
    tokens: int
    vocabulary: int

    def probabilities(self, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        d, s = self.strengths.discounts[1], self.strengths.concentrations[1]
        return (customers - d * tables + (s + d * self.tables) / (self.vocabulary + 1)) / (s + self.customers)

    def base(self, learnt: np.ndarray) -> np.ndarray:
        return np.log10((learnt + 0.5) / (self.tokens + 0.5 * (self.vocabulary + 1)))


class Bucket:
    """The restaurants' cells of some words, and their seating."""

    def __init__(self, number: int, cells: bytes, seats: bytes | None, hot: np.ndarray):
        key, self.c, self.words, contexts = _unpack(cells)
        key, self.contexts = np.cumsum(key), _from_planes(contexts)
        self.number = number
        self.word, self.k = key // len(self.contexts), key % len(self.contexts)
        self.learnt = np.bincount(self.word, self.c, len(self.words)).astype(np.int64)
        self.often = np.isin(self.words, hot)
        self.hot_at = np.searchsorted(hot, self.words[self.often])
        if seats is None:
            self.t = np.minimum(self.c, 1)
            self.root_t = (self.learnt > 0).astype(np.int64)
            self.total = np.zeros(len(self.c), np.float32)
        else:
            t, root_t, self.total = _unpack(seats)
            self.t, self.root_t = t.astype(np.int64), root_t.astype(np.int64)

    def seats(self) -> bytes:
        return _pack(self.t.astype(np.uint32), self.root_t.astype(np.uint32), self.total)

    def sent(self) -> np.ndarray:
        """Customers of the parent restaurant from these cells, word by word."""
        return np.bincount(self.word, self.t, len(self.words)).astype(np.int64)

    def sums(self, hot: int) -> np.ndarray:
        """Learnt tokens, vocabulary, customers and tables of the parent but for frequent words; those words' own."""
        out = np.zeros(4 + 2 * hot, np.int64)
        rest, sent = ~self.often, self.sent()
        out[:4] = self.c.sum(), (self.learnt[rest] > 0).sum(), sent[rest].sum(), self.root_t[rest].sum()
        np.add.at(out, 4 + self.hot_at, self.learnt[self.often])
        np.add.at(out, 4 + hot + self.hot_at, sent[self.often])
        return out

    def shares(self) -> tuple[np.ndarray, np.ndarray]:
        """This bucket's part of each context's customers and tables."""
        n = len(self.contexts)
        return np.bincount(self.k, self.c, n).astype(np.int64), np.bincount(self.k, self.t, n).astype(np.int64)

    def parent(self, root: Root) -> np.ndarray:
        customers, tables = self.sent(), self.root_t.copy()
        customers[self.often], tables[self.often] = root.hot_customers[self.hot_at], root.hot_tables[self.hot_at]
        return root.probabilities(customers, tables)

    def predictive(self, root: Root, guests: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """Probability of each cell's word after its context, under the present seating."""
        d, s = root.strengths.discounts[0], root.strengths.concentrations[0]
        return (self.c - d * self.t + (s + d * tables[self.k]) * self.parent(root)[self.word]) / (s + guests[self.k])

    def sweep(self, number: int, root: Root, tables: np.ndarray) -> None:
        """Reseat the customers of every cell, then the parent's, given all others as of the last sweep."""
        rng = np.random.default_rng([root.strengths.seed, number, self.number])
        (d, e), (s, r) = root.strengths.discounts, root.strengths.concentrations
        self.t = reseat(self.c, tables[self.k] - self.t, self.parent(root)[self.word], d, s, rng)
        flat = np.full(len(self.words), 1 / (root.vocabulary + 1))
        self.root_t = reseat(self.sent() * ~self.often, root.tables - self.root_t, flat, e, r, rng)


def _root(state: DataFrame, strengths: Strengths, hot: np.ndarray, before: Root | None, number: int) -> Root:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(4 + 2 * len(hot), np.int64)
        for b in _buckets(batches, hot):
            total += b.sums(len(hot))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["x"])

    found = [np.frombuffer(bytes(r.x), np.int64) for r in _sum_rows(state.mapInArrow(run, "x binary")).collect()]
    total = sum(found, np.zeros(4 + 2 * len(hot), np.int64))
    learnt, customers = total[4 : 4 + len(hot)], total[4 + len(hot) :]
    vocabulary = int(total[1] + (learnt > 0).sum())
    if before is None:
        tables = np.minimum(customers, 1)
    else:
        flat = np.full(len(hot), 1 / (vocabulary + 1))
        tables = reseat(customers, before.tables - before.hot_tables, flat, strengths.discounts[1], strengths.concentrations[1], np.random.default_rng([strengths.seed, number]))
    return Root(strengths, hot, learnt, customers, tables, int(total[2] + customers.sum()), int(total[3] + tables.sum()), int(total[0]), vocabulary)


def _sum_rows(df: DataFrame) -> DataFrame:
    """The tasks' arrays (column x), added up in about the square root of their number of groups."""
    groups = max(1, int(parallelism(df.sparkSession) ** 0.5))

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"x": [sum(np.frombuffer(x, np.int64) for x in rows.x).tobytes()]})

    return df.withColumn("g", F.pmod(F.spark_partition_id(), F.lit(groups))).groupBy("g").applyInPandas(add, "x binary")


def _buckets(batches: Iterator[pa.RecordBatch], hot: np.ndarray) -> Iterator[Bucket]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield Bucket(*(batch.column(c)[i].as_py() for c in ("bucket", "cells", "seats")), hot)


def _group_of(contexts: np.ndarray, groups: int) -> np.ndarray:
    return ((contexts >> np.uint64(8)) % np.uint64(groups)).astype(np.int64)


def _totals(state: DataFrame, hot: np.ndarray, groups: int) -> DataFrame:
    """Rows (bucket, part, totals): customers and tables over all buckets of a bucket's contexts in one group."""

    def offer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _buckets(batches, hot):
            guests, tables = b.shares()
            group = _group_of(b.contexts, groups)
            rows = [(g, b.number, _pack(_planes(b.contexts[own]), guests[own], tables[own])) for g in np.unique(group) for own in [group == g]]
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, t in enumerate((pa.int64(), pa.int64(), pa.binary()))], ["part", "bucket", "data"])

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        offers = [(_from_planes(known), *shares) for known, *shares in map(_unpack, rows.data)]
        known, where = np.unique(np.concatenate([o[0] for o in offers]), return_inverse=True)
        guests, tables = (np.bincount(where, np.concatenate([o[i] for o in offers]), len(known)).astype(np.int64) for i in (1, 2))
        out, at = [], 0
        for o in offers:
            own = where[at : at + len(o[0])]
            at += len(o[0])
            out.append(_pack(guests[own], tables[own]))
        return pd.DataFrame({"bucket": rows.bucket, "part": rows.part, "totals": out})

    return state.mapInArrow(offer, "part bigint, bucket bigint, data binary").groupBy("part").applyInPandas(add, "bucket bigint, part bigint, totals binary")


_STATE = "bucket bigint, seats binary"


def _step(cells: DataFrame, state: DataFrame, root: Root, number: int, groups: int) -> DataFrame:
    """Count the present seating if the burn-in is over, then sweep; after the last sweep give logarithms."""
    hot, strengths = root.hot, root.strengths
    last = number == strengths.burn_in + strengths.samples

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                b = Bucket(*(batch.column(c)[i].as_py() for c in ("bucket", "cells", "seats")), hot)
                group = _group_of(b.contexts, groups)
                guests, tables = np.zeros((2, len(group)), np.int64)
                for part in batch.column("parts")[i].as_py():
                    guests[group == part["part"]], tables[group == part["part"]] = _unpack(part["totals"])
                if number > strengths.burn_in:
                    b.total = b.total + b.predictive(root, guests, tables).astype(np.float32)
                if last:
                    learnt = b.learnt.copy()
                    learnt[b.often] = root.hot_learnt[b.hot_at]
                    seats = _pack(np.log10(b.total.astype(float) / strengths.samples).astype(np.float32), learnt, b.word.astype(np.uint32))
                else:
                    b.sweep(number + 1, root, tables)
                    seats = b.seats()
                yield pa.RecordBatch.from_arrays([pa.array([b.number], pa.int64()), pa.array([seats], pa.binary())], ["bucket", "seats"])

    both = _seated(cells, state)
    parts = _totals(both, hot, groups).groupBy("bucket").agg(F.collect_list(F.struct("part", "totals")).alias("parts"))  # ``groups`` of them
    return both.join(parts, "bucket").mapInArrow(run, _STATE)


def _seated(cells: DataFrame, state: DataFrame | None) -> DataFrame:
    return cells.join(state, "bucket") if state is not None else cells.withColumn("seats", F.lit(None).cast("binary"))


def _train(cells: DataFrame, strengths: Strengths, hot: np.ndarray, groups: int) -> tuple[DataFrame, Root]:
    """Rows (bucket, seats) with the logarithms of the cells' mean predictive probabilities; the last root."""
    state, root = None, None
    for number in range(strengths.burn_in + strengths.samples + 1):
        root = _root(_seated(cells, state), strengths, hot, root, number)
        after = stage_table(_step(cells, state, root, number, groups), "seating", by="bucket")
        if state is not None:
            discard(state)
        state = after
    return state, root


def _sums(at: int, doc: np.ndarray, n: np.ndarray, learnt: np.ndarray, base: np.ndarray, score: np.ndarray) -> tuple[int, bytes]:
    """A slice's sums for the documents that have any: tokens, known tokens, fixed-point logs."""
    own, where = np.unique(doc, return_inverse=True)
    sums = []
    for values in (np.ones(len(n), np.int64), (learnt > 0).astype(np.int64), np.rint(-base * _FIXED).astype(np.int64), np.rint(-score * _FIXED).astype(np.int64)):
        total = np.zeros(len(own), np.int64)
        np.add.at(total, where, values * n)
        sums.append(total)
    return at, _pack(own.astype(np.uint16), sums[0].astype(np.uint32), sums[1].astype(np.uint32), *sums[2:])


def score_documents(docs: DataFrame, strengths: Strengths = Strengths(), *, slice_bytes: int = 2 << 20, bucket_bytes: int = 16 << 20) -> DataFrame:
    """One row per document: the held-out flag, token counts, and base and model log10 probabilities.

    Documents whose crc32(doc_id as text) mod 5 is 1 are held out; the others train the model. ``n_known``
    counts tokens seen in training, ``train_tokens`` is the size of the training text. ``perplexity`` is
    10 ** (-score / n_tokens).

    Words are dealt to 200 buckets, or to one for every ``bucket_bytes`` of text where that is more; the
    sampler's draws depend on the texts and on these parameters, not on the session's settings.

    A null or empty text is its end token alone. Rows that repeat count each; a null doc_id hashes as empty
    text. With nothing to train on, every word gets the base of an empty vocabulary. Further columns are
    ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(200, -(-total // bucket_bytes))
    hot = np.sort(np.array(_frequent(docs, buckets, slice_bytes), np.uint64))
    posted = _postings(docs, buckets, hot, slice_bytes)
    merged = stage_table(posted.groupBy("bucket").applyInPandas(_merging(hot, buckets), _MERGED), "restaurants", by="bucket")
    cells = merged.where("cells is not null").select("bucket", "cells")
    seated, root = _train(cells, strengths, hot, max(32, buckets // 4))
    logs = np.zeros((len(hot), len(hot)), np.float32)
    for r in seated.where(F.col("bucket") >= buckets).collect():  # MOST_HOT rows of as many numbers at most
        logs[r.bucket - buckets] = _unpack(bytes(r.seats))[0]
    shared = spark.sparkContext.broadcast(logs)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for at, seats, data in zip(*(batch.column(c).to_pylist() for c in ("slice", "seats", "data"))):
                parts = _unpack(data)
                if seats is not None:
                    logp, own, word = _unpack(seats)
                    base = root.base(own)
                    for head, step, doc, n in zip(*(parts[i::4] for i in range(4))):
                        cell = np.cumsum(step)
                        w = word[cell]
                        out.append(_sums(int(head[0]), doc, n, own[w], base[w], logp[cell]))
                else:
                    w, k, doc, n = parts
                    out.append(_sums(at, doc, n, root.hot_learnt[w], root.base(root.hot_learnt)[w], shared.value[w, k]))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.binary())], ["slice", "data"])

    posted = merged.where("kind = 'm'").select("bucket", "slice", "data").join(seated, "bucket").select("slice", "seats", "data")
    posted = posted.unionByName(merged.where("kind = 'h'").select("slice", F.lit(None).cast("binary").alias("seats"), "data"))
    scored = posted.mapInArrow(score, "slice bigint, data binary").withColumn("docs", F.lit(False))
    listed = merged.where("kind = 'd'").select("slice", "data", F.lit(True).alias("docs"))
    train_tokens = root.tokens

    def gather(rows: pd.DataFrame) -> pd.DataFrame:
        ids = _unpack(rows.data[rows.docs].iloc[0])
        sums = np.zeros((4, len(ids[0])), np.int64)
        for data in rows.data[~rows.docs]:
            own, *parts = _unpack(data)
            for total, part in zip(sums, parts):
                np.add.at(total, own, part)
        score = -sums[3] / _FIXED
        return pd.DataFrame(
            {
                "doc_id": pd.array(ids[1], "Int64") if not ids[0].any() else pd.array([None if z else i for z, i in zip(ids[0], ids[1])], "Int64"),
                "held_out": ids[2],
                "n_tokens": sums[0],
                "n_known": sums[1],
                "train_tokens": train_tokens,
                "base_score": -sums[2] / _FIXED,
                "score": score,
                "perplexity": 10 ** np.minimum(-score / np.maximum(sums[0], 1), 300),
            }
        )

    return scored.unionByName(listed).groupBy("slice").applyInPandas(gather, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, perplexity double")
