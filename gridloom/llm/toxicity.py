"""Toxicity by a classifier chain.

Categories are predicted one after another by linear models; each later model also sees the earlier
categories' probabilities. In training those are out-of-fold predictions, so that a later model learns to
trust them as far as they hold on unseen texts. Models are fitted in one task on a bounded sample of
labelled documents and score every document where it is read.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import slices
from gridloom.llm.decontamination import words_of

DENSE = 7


def dense_features(text: str, words: list[bytes]) -> list[float]:
    """Shape of a text: length, share of other characters, repetition, line and word lengths."""
    size = max(1, len(text.encode("utf-8", "surrogatepass")))
    letters = sum(map(len, words))
    n = max(1, len(words))
    lines = text.count("\n") + 1
    return [
        np.log1p(len(words)),
        1 - letters / size,
        1 - len(set(words)) / n,
        letters / n,
        np.log1p(len(words) / lines),
        np.log1p(text.count("|") + text.count("#") + text.count("$")),
        sum(w[:1].isdigit() for w in words) / n,
    ]


@dataclass
class Linear:
    """A logistic model over shape features, earlier probabilities and the presence of chosen words."""

    words: np.ndarray  # hashes of the chosen words, sorted
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def matrix(self, dense: np.ndarray, found: list[np.ndarray]) -> np.ndarray:
        x = np.zeros((len(dense), 1 + dense.shape[1] + len(self.words)))
        x[:, 0] = 1
        x[:, 1 : 1 + dense.shape[1]] = (dense - self.mean) / self.scale
        for row, own in zip(x, found):
            if len(self.words):
                at = np.minimum(np.searchsorted(self.words, own), len(self.words) - 1)
                row[1 + dense.shape[1] + at[self.words[at] == own]] = 1
        return x

    def probability(self, dense: np.ndarray, found: list[np.ndarray]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.matrix(dense, found) @ self.weights, -30, 30)))


def fit_linear(dense: np.ndarray, found: list[np.ndarray], label: np.ndarray, *, most_words: int = 300, chance: float = 0.5, ridge: float = 0.2) -> Linear:
    """Choose words by evidence, then fit by Newton's method with a ridge.

    A word's evidence is its count times the divergence of its label rate from the overall one; of words
    without meaning about ``chance`` would pass by luck. Shape features get ten times the ridge of words.
    """
    flat = np.concatenate(found) if found else np.zeros(0, np.uint64)
    owner = np.repeat(label, [len(f) for f in found]) if found else np.zeros(0)
    words, where, n = np.unique(flat, return_inverse=True, return_counts=True)
    hits = np.bincount(where, owner, len(words)) if len(words) else np.zeros(0)
    rate = float(label.mean()) if len(label) else 0.0
    own = hits / np.maximum(n, 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        apart = np.nan_to_num(own * np.log(own / rate)) + np.nan_to_num((1 - own) * np.log((1 - own) / (1 - rate)))
    evidence = n * apart
    good = np.flatnonzero(evidence >= np.log(max(2, (n > 1).sum()) / chance))
    good = good[np.argsort(-evidence[good], kind="stable")[:most_words]]
    model = Linear(np.sort(words[good]), dense.mean(0) if len(dense) else np.zeros(dense.shape[1]), np.maximum(dense.std(0), 1e-9) if len(dense) else np.ones(dense.shape[1]), np.zeros(0))
    model.weights = np.zeros(1 + dense.shape[1] + len(model.words))
    model.weights[0] = np.log((label.sum() + 0.5) / (len(label) - label.sum() + 0.5)) if len(label) else -30.0
    if not len(label) or label.min() == label.max():
        return model
    x, penalty = model.matrix(dense, found), np.full(len(model.weights), ridge)
    penalty[0], penalty[1 : 1 + dense.shape[1]] = 0, 10 * ridge
    for _ in range(20):
        p = 1 / (1 + np.exp(-np.clip(x @ model.weights, -30, 30)))
        spread = np.zeros((x.shape[1], x.shape[1]))
        for i in range(0, len(x), 1000):  # in slices, as a weighted copy of the matrix would double it
            part = x[i : i + 1000]
            spread += (part * (p * (1 - p))[i : i + 1000, None]).T @ part
        step = np.linalg.solve(spread + np.diag(penalty + 1e-6), x.T @ (label - p) - penalty * model.weights)
        model.weights = model.weights + step
        if np.abs(step).max() < 1e-6:
            break
    return model


@dataclass
class Chain:
    categories: tuple[str, ...]
    models: list[Linear] = field(default_factory=list)

    def probabilities(self, dense: np.ndarray, found: list[np.ndarray]) -> np.ndarray:
        """(documents, categories), each category seeing those before it."""
        out = np.zeros((len(dense), len(self.categories)))
        for j, model in enumerate(self.models):
            out[:, j] = model.probability(np.concatenate([dense, out[:, :j]], 1), found)
        return out


def fit_chain(categories: tuple[str, ...], dense: np.ndarray, found: list[np.ndarray], labels: np.ndarray, folds: np.ndarray, **options) -> Chain:
    """Fit the chain; ``folds`` numbers each row's fold for the out-of-fold probabilities, options are those of ``fit_linear``."""
    chain, earlier = Chain(categories), np.zeros((len(dense), 0))
    for j in range(len(categories)):
        x, y = np.concatenate([dense, earlier], 1), labels[:, j].astype(float)
        chain.models.append(fit_linear(x, found, y, **options))
        own = np.zeros(len(x))
        for f in np.unique(folds):
            inside, outside = folds == f, folds != f
            model = fit_linear(x[outside], [w for w, o in zip(found, outside) if o], y[outside], **options)
            own[inside] = model.probability(x[inside], [w for w, i in zip(found, inside) if i])
        earlier = np.concatenate([earlier, own[:, None]], 1)
    return chain


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.unique(np.array([xxhash.xxh3_64_intdigest(w) for w in set(words)], np.uint64))


def train(docs: DataFrame, labels: DataFrame, *, sample: int = 5_000, folds: int = 5, most_words: int = 300) -> Chain:
    """Fit the categories low_quality, then toxic, on at most ``sample`` labelled documents.

    The sample takes the labelled ids of least hash; a larger labels table changes which documents are
    fitted on, not how many. Rows of ``labels`` with nulls are left out, of rows that repeat an id the
    largest labels count; of documents that share an id one is taken. Ids may have any type. A model uses
    at most ``most_words`` words, those of most evidence. Without labelled documents every probability is
    near 0.
    """
    known = labels.where("doc_id is not null and quality is not null and toxic is not null")
    known = known.groupBy("doc_id").agg((1 - F.min("quality")).alias("low_quality"), F.max("toxic").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # a bounded number of ids

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 8 << 20):
            dense, found = [], []
            for t in batch.column("text").to_pylist():
                words = words_of(t)
                dense.append(dense_features(t or "", words))
                found.append(_hashes(words).tobytes())
            columns = [batch.column(c) for c in ("doc_id", "low_quality", "toxic")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(dense, pa.list_(pa.float64())), pa.array(found, pa.binary())], ["doc_id", "low_quality", "toxic", "dense", "found"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = sorted((r for b in batches for r in b.to_pylist()), key=lambda r: (str(r["doc_id"]), r["found"]))
        dense = np.array([r["dense"] for r in got]).reshape(-1, DENSE)
        found = [np.frombuffer(r["found"], np.uint64) for r in got]
        y = np.array([(r["low_quality"], r["toxic"]) for r in got]).reshape(-1, 2)
        own_fold = np.array([zlib.crc32(str(r["doc_id"]).encode()) % folds for r in got])
        chain = fit_chain(("low_quality", "toxic"), dense, found, y, own_fold, most_words=most_words)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(chain)], pa.binary())], ["chain"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    got = rows.select("doc_id", F.col("low_quality").cast("int"), F.col("toxic").cast("int"), "text").mapInArrow(describe, f"doc_id {kind}, low_quality int, toxic int, dense array<double>, found binary")
    got = got.groupBy("doc_id").agg(F.min(F.struct("found", "dense", "low_quality", "toxic")).alias("r")).select("doc_id", "r.*")
    return pickle.loads(got.coalesce(1).mapInArrow(fit, "chain binary").first().chain)


def _scored(docs: DataFrame, chain: Chain, key: str, slice_bytes: int) -> DataFrame:
    chosen = np.unique(np.concatenate([m.words for m in chain.models] or [np.zeros(0, np.uint64)]))
    wanted = set(chosen.tolist())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, int | None] = {}
        for batch in slices(batches, "__text", slice_bytes):
            dense, found = [], []
            for t in batch.column("__text").to_pylist():
                words = words_of(t)
                dense.append(dense_features(t or "", words))
                own = []
                for w in set(words):
                    h = seen.get(w, 0)
                    if h == 0:
                        h = xxhash.xxh3_64_intdigest(w)
                        h = h if h in wanted else None
                        if len(seen) > 1_000_000:
                            seen.clear()
                        seen[w] = h
                    if h is not None:
                        own.append(h)
                found.append(np.unique(np.array(own, np.uint64)))
            p = chain.probabilities(np.array(dense).reshape(-1, DENSE), found)
            yield pa.RecordBatch.from_arrays([batch.column(key), *(pa.array(np.ascontiguousarray(c)) for c in p.T)], [key, *chain.categories])

    kind = docs.schema[key].dataType.simpleString()
    return docs.mapInArrow(run, f"`{key}` {kind}, " + ", ".join(f"`{c}` double" for c in chain.categories))


def score_toxicity(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.5, sample: int = 5_000, most_words: int = 300, slice_bytes: int = 4 << 20) -> DataFrame:
    """doc_id, the categories' probabilities in the chain's order, and whether the document is toxic.

    Whole texts count; a null or empty text has no words. Rows that repeat and null ids are scored like
    others; further columns are ignored.
    """
    chain = train(docs, labels, sample=sample, most_words=most_words)
    scored = _scored(docs.select("doc_id", F.col("text").alias("__text")), chain, "doc_id", slice_bytes)
    return scored.select("doc_id", *[F.col(c).alias(f"p_{c}") for c in chain.categories], (F.col("toxic") >= threshold).alias("toxic"))


def drop_toxic(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.5, sample: int = 5_000, most_words: int = 300, slice_bytes: int = 4 << 20) -> DataFrame:
    """``docs`` without the toxic rows; all columns stay, and no join is needed."""
    chain = train(docs, labels, sample=sample, most_words=most_words)
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col("text").alias("__text"))
    return _scored(whole, chain, "__row", slice_bytes).where(F.col("toxic") < threshold).select("__row.*")
