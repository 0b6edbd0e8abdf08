"""Document quality by attention over passages, a multiple-instance model.

A text is a bag of passages of consecutive words. Every passage is encoded; gated attention gives each a
weight, learned from the documents' labels alone; the weighted mean of the encodings is scored. The model
is fitted in one task on a bounded sample of labelled documents and scores every whole text where it is
read, a block of passages at a time: partial sums of attention are put together by document.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import slices

#: Kinds of bytes: letters, digits, blanks, line ends, bytes beyond ASCII, control bytes, and each ASCII sign by itself.
_KIND = np.array([0 if 97 <= c <= 122 else 1 if 65 <= c <= 90 else 2 if 48 <= c <= 57 else 3 if c in b" \t" else 4 if c in b"\n\v\f\r" else 5 if c >= 128 else 6 if c < 32 or c == 127 else -1 for c in range(256)])
_KIND[_KIND < 0] = 7 + np.arange((_KIND < 0).sum())
KINDS = int(_KIND.max()) + 1
_BLANK = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
SHAPES, BUCKETS = 4, 256
WIDTH = KINDS + SHAPES + BUCKETS


def passages(texts: list[str | None], per: int, block: int = 4096) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document of each passage, features) in blocks; passages are of ``per`` words, a text without words is one empty passage.

    Features are shares of the kinds of bytes, the share of distinct words and of words that repeat the one
    before, word length and number, and words hashed to buckets.
    """
    stripped = [(t or "").encode("utf-8", "surrogatepass").strip() for t in texts]
    filled = np.array([i for i, t in enumerate(stripped) if t], np.int64)
    data = b"".join(stripped[i] + b"\n" for i in filled)
    raw = np.frombuffer(data, np.uint8)
    blank = _BLANK[raw]
    starts = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]])) if len(raw) else np.zeros(0, np.int64)
    owner = filled[np.searchsorted(np.cumsum([len(stripped[i]) + 1 for i in filled]), starts, "right")] if len(filled) else filled
    number = np.arange(len(starts)) - np.searchsorted(owner, owner)
    head = np.flatnonzero(number % per == 0)
    for p in range(0, len(head), block):
        own = head[p : p + block]
        after = head[p + block] if p + block < len(head) else len(starts)
        begin, end = starts[own[0]], starts[after] if after < len(starts) else len(raw)
        yield owner[own], _features(data[begin:end], raw[begin:end], starts[own] - begin, np.diff(np.append(own, after)))
    none = np.array([i for i, t in enumerate(stripped) if not t], np.int64)
    if len(none):
        yield none, np.zeros((len(none), WIDTH))


def _features(piece: bytes, raw: np.ndarray, heads: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    n = len(heads)
    lengths = np.diff(np.append(heads, len(raw)))
    kinds = np.bincount(np.repeat(np.arange(n), lengths) * KINDS + _KIND[raw], minlength=n * KINDS).reshape(n, KINDS)
    words = piece.split()
    where = np.repeat(np.arange(n), sizes)
    code = np.fromiter(map(crc32, words), np.int64, len(words))
    distinct = np.bincount(np.unique((where << 32) | code) >> 32, minlength=n)
    again = np.bincount(where[1:], (code[1:] == code[:-1]) & (where[1:] == where[:-1]), n)
    hashed = np.bincount(where * BUCKETS + code % BUCKETS, minlength=n * BUCKETS).reshape(n, BUCKETS)
    out = np.empty((n, WIDTH))
    out[:, :KINDS] = kinds / lengths[:, None]
    out[:, KINDS : KINDS + SHAPES] = np.stack([1 - distinct / sizes, again / sizes, np.log1p(lengths / sizes), np.log1p(sizes)], 1)
    out[:, KINDS + SHAPES :] = hashed / np.sqrt(sizes)[:, None]
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Attention:
    """Encoder, gated attention and scorer. ``fitted`` is False without examples of both labels: then ``rate`` is every score."""

    mean: np.ndarray
    scale: np.ndarray
    rate: float
    fitted: bool = True
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def start(cls, mean: np.ndarray, scale: np.ndarray, rate: float, hidden: int, gate: int, seed: int) -> Attention:
        rng = np.random.default_rng(seed)
        made = {"encode": rng.normal(0, (1 / len(mean)) ** 0.5, (len(mean), hidden)), "shift": np.zeros(hidden), "tanh": rng.normal(0, hidden**-0.5, (hidden, gate)), "gate": rng.normal(0, hidden**-0.5, (hidden, gate)), "attend": rng.normal(0, gate**-0.5, gate), "score": rng.normal(0, hidden**-0.5, hidden), "bias": np.array(np.log(rate / (1 - rate)))}
        return cls(mean, scale, rate, True, made)

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def encoded(self, x: np.ndarray) -> tuple[np.ndarray, ...]:
        """Encoding, both halves of the gate, and attention before its softmax, of scaled passages."""
        w = self.weights
        h = np.tanh(x @ w["encode"] + w["shift"])
        t, s = np.tanh(h @ w["tanh"]), _sigmoid(h @ w["gate"])
        return h, t, s, (t * s) @ w["attend"]

    def loss_and_slopes(self, x: np.ndarray, starts: np.ndarray, label: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean logistic loss of documents whose scaled passages begin at ``starts``, and its gradient."""
        w, n = self.weights, len(starts)
        own = np.repeat(np.arange(n), np.diff(np.append(starts, len(x))))
        h, t, s, e = self.encoded(x)
        a = np.exp(e - np.maximum.reduceat(e, starts)[own])
        a /= np.add.reduceat(a, starts)[own]
        z = np.add.reduceat(a[:, None] * h, starts)
        p = _sigmoid(z @ w["score"] + w["bias"])
        loss = -np.mean(label * np.log(p) + (1 - label) * np.log(1 - p))
        d = (p - label) / n
        dz = (d[:, None] * w["score"])[own]
        da = (dz * h).sum(1)
        de = a * (da - np.add.reduceat(a * da, starts)[own])
        dg = de[:, None] * w["attend"]
        dt, ds = dg * s * (1 - t * t), dg * t * s * (1 - s)
        dh = (a[:, None] * dz + dt @ w["tanh"].T + ds @ w["gate"].T) * (1 - h * h)
        slopes = {"encode": x.T @ dh, "shift": dh.sum(0), "tanh": h.T @ dt, "gate": h.T @ ds, "attend": (t * s).T @ de, "score": z.T @ d, "bias": d.sum()}
        return float(loss), slopes

    def scores(self, texts: list[str | None], per: int) -> np.ndarray:
        """Every text's score; its passages may come in several blocks."""
        if not self.fitted:
            return np.full(len(texts), self.rate)
        n, hidden = len(texts), len(self.weights["score"])
        top, mass, sums = np.full(n, -np.inf), np.zeros(n), np.zeros((n, hidden))
        for owner, x in passages(texts, per):
            h, _, _, e = self.encoded(self.scaled(x))
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            doc, own = owner[starts], np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(owner))))
            high = np.maximum(top[doc], np.maximum.reduceat(e, starts))
            a, before = np.exp(e - high[own]), np.exp(top[doc] - high)
            mass[doc] = mass[doc] * before + np.add.reduceat(a, starts)
            sums[doc] = sums[doc] * before[:, None] + np.add.reduceat(a[:, None] * h, starts)
            top[doc] = high
        return _sigmoid(sums / mass[:, None] @ self.weights["score"] + self.weights["bias"])


def fit_attention(bags: list[np.ndarray], label: np.ndarray, *, hidden: int = 24, gate: int = 12, epochs: int = 30, batch: int = 32, rate: float = 0.005, decay: float = 0.0005, seed: int = 7) -> Attention:
    """Fit on bags of passages by Adam with weight decay; passages' features are scaled by the sample's spread."""
    share = float((label.sum() + 0.5) / (len(label) + 1)) if len(label) else 0.5
    if not len(label) or label.min() == label.max():
        return Attention(np.zeros(WIDTH), np.ones(WIDTH), share, False)
    every = np.concatenate(bags)
    model = Attention.start(every.mean(0), np.maximum(every.std(0), 0.01), share, hidden, gate, seed)
    bags = [model.scaled(b).astype(np.float32) for b in bags]
    rng, step = np.random.default_rng(seed), 0
    first, second = ({k: np.zeros_like(v) for k, v in model.weights.items()} for _ in range(2))
    for epoch in range(epochs):
        pace = rate * (1 - epoch / epochs)
        order = rng.permutation(len(bags))
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            x = np.concatenate([bags[i] for i in chosen]).astype(np.float64)
            starts = np.cumsum([0, *(len(bags[i]) for i in chosen[:-1])])
            _, slopes = model.loss_and_slopes(x, starts, label[chosen])
            step += 1
            for k, g in slopes.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
                model.weights[k] = model.weights[k] - pace * move - (pace * decay * 20 * model.weights[k] if k != "bias" else 0)
    return model


def train_quality(docs: DataFrame, labels: DataFrame, trainable, *, sample: int = 3_000, most_passages: int = 64, per: int = 64, **options) -> Attention:
    """Fit on at most ``sample`` labelled documents for which ``trainable`` (a Column on doc_id) holds.

    Those of the least hash of the id are taken. Of a fitted document with over ``most_passages`` passages as
    many are used, evenly spread; scoring uses all. Rows of ``labels`` with nulls are left out; of rows that
    repeat an id the least quality counts, and one of the documents that share it.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).where(trainable)
    chosen = known.groupBy("doc_id").agg(F.min("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # ``sample`` ids at most
    kind = docs.schema["doc_id"].dataType.simpleString()

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4 << 20):
            bags = []
            for t in batch.column("text").to_pylist():
                x = np.concatenate([x for _, x in passages([t], per)])
                if len(x) > most_passages:
                    x = x[np.linspace(0, len(x) - 1, most_passages).astype(int)]
                bags.append(x.astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), pa.array(bags, pa.binary())], ["doc_id", "quality", "bag"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = sorted((r for b in batches for r in b.to_pylist()), key=lambda r: str(r["doc_id"]))
        bags = [np.frombuffer(r["bag"], np.float32).reshape(-1, WIDTH) for r in got]
        model = fit_attention(bags, np.array([float(r["quality"] > 0) for r in got]), **options)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    described = rows.select("doc_id", F.col("quality").cast("int"), "text").mapInArrow(describe, f"doc_id {kind}, quality int, bag binary")
    one = described.groupBy("doc_id").agg(F.min(F.struct("bag", "quality")).alias("r")).select("doc_id", "r.*")
    return pickle.loads(one.coalesce(1).mapInArrow(fit, "model binary").first().model)


def score_quality(docs: DataFrame, labels: DataFrame, *, folds: int = 4, held_out_fold: int = 2, threshold: float = 0.7, per: int = 64, sample: int = 3_000, most_passages: int = 64, slice_bytes: int = 4 << 20) -> DataFrame:
    """doc_id, held_out, score (0 to 1, six digits) and predicted of every row.

    Labels are learned where crc32 of the id's text, modulo ``folds``, is not ``held_out_fold``; a null id has
    the empty text. Only the text makes a score. Null and empty texts are one empty passage. Rows that repeat,
    very long texts and ids of any type are scored like others; without labels of both kinds every score is
    the labels' rate (0.5 without labels). An empty table gives an empty result; further columns are ignored.
    """
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % folds
    model = train_quality(docs, labels, fold != held_out_fold, sample=sample, most_passages=most_passages, per=per)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", slice_bytes):
            score = np.round(model.scores(batch.column("text").to_pylist(), per), 6)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select("doc_id", (fold == held_out_fold).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
