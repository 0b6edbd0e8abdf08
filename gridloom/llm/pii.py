"""Personal data by weak supervision.

Strict patterns find the base spans, which always stay. Looser patterns propose further candidates. For
every candidate regex, gazetteer and context labelers vote; the votes' patterns are counted over the whole
corpus, and expectation-maximisation, kind by kind, turns those of the further candidates into
reliabilities and soft labels. A logistic span classifier trained on them, with the base spans as certain
ones, decides which further candidates are spans. Every kind weighs the same, however often it occurs and
however large the corpus is, so shares of patterns matter and counts do not. Only counts of patterns,
whose number is bounded by the labelers and feature bins, reach the driver.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect, insort
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import slices

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "secret", "handle", "number")

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Looser proposals beside the base patterns.
_SECRET = re.compile(r"[A-Za-z0-9_+/=-]{20,}")
_HANDLE = re.compile(r"(?<![A-Za-z0-9._%+-])@[A-Za-z0-9_]{3,30}(?![A-Za-z0-9_.-]*\.[A-Za-z0-9])")
_NUMBER = re.compile(r"(?<![0-9A-Za-z+])[0-9](?:[\x20./()-]?[0-9]){6,}(?![0-9A-Za-z])")
# Gazetteers, fixed values.
_ISSUERS = ("34", "37", "4", "51", "52", "53", "54", "55", "6011", "62", "65")
_KEY_WORDS = {"secret": ("token", "key", "secret", "password", "passwd", "passphrase", "pwd", "bearer", "auth", "credential", "signature", "cookie", "session"), "email": ("mail", "e-mail", "contact", "write", "reply"), "ip": ("ip", "host", "server", "address", "login"), "card": ("card", "visa", "account", "credit", "payment"), "phone": ("phone", "tel", "call", "mobile", "fax"), "handle": ("follow", "twitter", "user", "account", "by"), "number": ("ssn", "passport", "tax id", "iban", "id:", "id ", "account", "insurance", "licence no", "license no", "social security")}
_DOMAIN_ENDS = ("com", "org", "net", "edu", "gov", "io", "de", "fr", "es", "uk", "info", "eu", "co")
_HARMLESS = ("version", "page", "isbn", "chapter", "figure", "section", "http", "doi", "commit", "sha", "md5", "license", "=\"data:")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the strict patterns, by start, then in the order of ``BASE``."""
    out = []
    if "@" in text:
        free = 0
        for m in _DOMAIN.finditer(text):
            start = m.start()
            while start > free and text[start - 1] in _LOCAL:
                start -= 1
            if start < m.start():
                out.append((start, m.end(), "email"))
                free = m.end()
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
            out.append((m.start(), m.end(), "ip"))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = re.sub("[^0-9]", "", m[0])
            if 14 <= len(digits) <= 19 and _luhn(digits):
                out.append((m.start(), m.end(), "card"))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((m.start(), m.end(), "phone"))
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2])))


def proposals(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Further candidates of the looser patterns that overlap neither the base spans nor each other."""
    out: list[tuple[int, int, str]] = []
    taken: list[tuple[int, int]] = []  # disjoint stretches, sorted
    for a, b, _ in base:
        if taken and a < taken[-1][1]:
            taken[-1] = (taken[-1][0], max(b, taken[-1][1]))
        else:
            taken.append((a, b))
    for kind, pattern in (("secret", _SECRET), ("handle", _HANDLE), ("number", _NUMBER)):
        if kind == "handle" and "@" not in text:
            continue
        for m in pattern.finditer(text):
            if kind == "secret" and not (any(c.isdigit() for c in m[0]) and any(c.isalpha() for c in m[0])):
                continue
            at = bisect(taken, m.span())
            if (at == 0 or taken[at - 1][1] <= m.start()) and (at == len(taken) or m.end() <= taken[at][0]):
                insort(taken, m.span())
                out.append((m.start(), m.end(), kind))
    return sorted(out)


def _regex_vote(kind: str, value: str, base: bool) -> int:
    if base:
        return 1
    if kind == "secret":
        return 1 if re.fullmatch(r"[0-9a-f]{32,}|[A-Za-z0-9_+/=-]*[0-9][A-Za-z0-9_+/=-]*", value) and len(set(value)) >= 10 else -1
    if kind == "number":
        return 1 if re.fullmatch(r"[0-9]{3}-[0-9]{2}-[0-9]{4}", value) else -1
    if kind == "handle":
        return 1 if any(c.isdigit() or c == "_" for c in value) else 0
    return 0


def _gazetteer_vote(kind: str, value: str) -> int:
    if kind == "email":
        return 1 if value.rsplit(".", 1)[-1].lower() in _DOMAIN_ENDS else -1
    if kind == "card":
        return 1 if re.sub("[^0-9]", "", value).startswith(_ISSUERS) else 0
    if kind == "ip":
        return -1 if value.startswith(("0.", "127.", "255.")) else 1
    if kind == "secret":
        return 1 if value.startswith(("ghp_", "sk-", "AKIA", "xox", "eyJ")) else 0
    return 0


def _context_vote(kind: str, before: str) -> int:
    return int(any(w in before for w in _KEY_WORDS[kind]))


def _harmless_vote(before: str, after: str) -> int:
    return -int(any(w in before for w in _HARMLESS) or after.startswith(("%", " %", "€", "$", " km", " kg")))


def _shape_vote(kind: str, value: str) -> int:
    letters = [c for c in value if c.isalnum()]
    variety = len(set(letters)) / max(1, min(len(letters), 16))
    if kind in ("secret", "number", "card"):
        return 1 if variety >= 0.5 else -1
    return 0


def _bin(x: int, edges: tuple[int, ...]) -> int:
    return sum(x > e for e in edges)


def describe(text: str, start: int, end: int, kind: str, base: bool) -> tuple[tuple[int, ...], tuple[int, ...]]:
    """(votes, binned features) of a candidate; votes are 1: personal, -1: not, 0: none."""
    value, before, after = text[start:end], text[max(0, start - 32) : start].lower(), text[end : end + 4]
    votes = (_regex_vote(kind, value, base), _gazetteer_vote(kind, value), _context_vote(kind, before), _harmless_vote(before, after), _shape_vote(kind, value))
    digits = sum(c.isdigit() for c in value)
    near = before[-1:]
    features = (
        KINDS.index(kind),
        _bin(len(value), (10, 16, 24, 36)),
        _bin(100 * digits // len(value), (10, 40, 80)),
        0 if not near or near.isspace() else 1 if near in "\"'=:(" else 2,
        _bin(len(set(value)), (4, 8, 12)),
        int(value.lower() == value),
        *(v + 1 for v in votes[:4]),
    )
    return votes, features


@dataclass
class SpanModel:
    """Reliabilities of the labelers by kind, and the classifier's weights over one-hot features."""

    reliabilities: dict[str, np.ndarray]  # kind to [label, labeler, vote + 1]
    priors: dict[str, float]
    weights: np.ndarray
    threshold: float = 0.5

    SIZES = (len(KINDS), 5, 4, 3, 4, 2, 3, 3, 3, 3)

    @staticmethod
    def rows(features: np.ndarray) -> np.ndarray:
        """One-hot rows with a constant, and the kind crossed with the length."""
        cols = [np.ones((len(features), 1))]
        for j, n in enumerate(SpanModel.SIZES):
            cols.append(np.eye(n)[features[:, j]])
        cols.append(np.eye(len(KINDS) * 5)[features[:, 0] * 5 + features[:, 1]])
        return np.concatenate(cols, 1)

    def probability(self, features: list[tuple[int, ...]]) -> np.ndarray:
        return 1 / (1 + np.exp(-self.rows(np.array(features)) @ self.weights))


#: Weight of one kind's candidates, whatever their number; what EM starts from weighs a good part of it.
MASS = 200.0
_BELIEF = 10.0 * np.array([[3.0, 2.0, 1.0], [1.0, 2.0, 3.0]])  # [label, vote + 1]: votes are right more often than wrong


def expectation_maximisation(votes: np.ndarray, counts: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, np.ndarray, float]:
    """(soft label of each pattern, reliabilities [label, labeler, vote + 1], prior) of one kind's candidates.

    Labelers are taken as independent given the label. Counts are scaled to ``MASS``, and the belief that
    votes are right more often than wrong counts as so many votes, which fixes the labels' meaning.
    """
    weights = counts / counts.sum() * MASS
    soft = 1 / (1 + np.exp(1.0 - 1.2 * votes.sum(1)))
    table, prior = np.zeros((2, votes.shape[1], 3)), 0.5
    for _ in range(rounds):
        own = np.stack([(1 - soft) * weights, soft * weights])
        prior = float((own[1].sum() + 10) / (MASS + 30))
        for v in (-1, 0, 1):
            table[:, :, v + 1] = own @ (votes == v) + _BELIEF[:, v + 1, None]
        table /= table.sum(2, keepdims=True)
        odds = np.log(prior / (1 - prior)) + sum(np.log(table[1, j, votes[:, j] + 1] / table[0, j, votes[:, j] + 1]) for j in range(votes.shape[1]))
        soft = 1 / (1 + np.exp(-odds))
    return soft, table, prior


def fit(patterns: list[tuple[tuple[int, ...], tuple[int, ...], int]], ridge: float = 1.0) -> SpanModel:
    """Train on counted (votes, features, count) patterns; without further candidates, a model that adds nothing."""
    width = 1 + sum(SpanModel.SIZES) + len(KINDS) * 5
    model = SpanModel({}, {}, np.zeros(width) - 1.0)
    if not patterns:
        return model
    votes, features = np.array([p[0] for p in patterns]), np.array([p[1] for p in patterns])
    counts = np.array([p[2] for p in patterns], float)
    soft, weights = np.ones(len(counts)), np.zeros(len(counts))
    for k, kind in enumerate(KINDS):
        own = features[:, 0] == k
        if not own.any():
            continue
        weights[own] = counts[own] / counts[own].sum() * MASS
        if kind not in BASE:
            soft[own], model.reliabilities[kind], model.priors[kind] = expectation_maximisation(votes[own], counts[own])
    x, w = SpanModel.rows(features), np.zeros(width)
    for _ in range(25):  # Newton steps on the weighted soft labels
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weights * (soft - p)) - ridge * w
        w = w + np.linalg.solve((x * (weights * p * (1 - p))[:, None]).T @ x + ridge * np.eye(width), gradient)
    model.weights = w
    return model


def train(docs: DataFrame, text_col: str = "text", slice_bytes: int = 8 << 20) -> SpanModel:
    """Count vote and feature patterns over all texts, then fit; the corpus itself is not collected."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in slices(batches, text_col, slice_bytes):
            for text in batch.column(text_col).to_pylist():
                text = text or ""
                base = base_spans(text)
                for a, b, kind in base:
                    seen[describe(text, a, b, kind, True)] += 1
                for a, b, kind in proposals(text, base):
                    seen[describe(text, a, b, kind, False)] += 1
        rows = list(seen.items())
        yield pa.RecordBatch.from_arrays(
            [pa.array([list(k[0]) for k, _ in rows], pa.list_(pa.int32())), pa.array([list(k[1]) for k, _ in rows], pa.list_(pa.int32())), pa.array([n for _, n in rows], pa.int64())],
            ["votes", "features", "n"],
        )

    counted = docs.select(text_col).mapInArrow(count, "votes array<int>, features array<int>, n bigint")
    rows = counted.groupBy("votes", "features").agg(F.sum("n").alias("n")).orderBy("votes", "features").collect()
    return fit([(tuple(r.votes), tuple(r.features), r.n) for r in rows])


def spans_of(text: str, model: SpanModel) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """(base spans, all spans) of one text."""
    base = base_spans(text)
    further = proposals(text, base)
    if further:
        chance = model.probability([describe(text, a, b, k, False)[1] for a, b, k in further])
        further = [s for s, p in zip(further, chance) if p >= model.threshold]
    return base, sorted([*base, *further], key=lambda x: (x[0], KINDS.index(x[2])))


def _listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def find_personal_data(docs: DataFrame, model: SpanModel | None = None, *, slice_bytes: int = 8 << 20) -> DataFrame:
    """One row per document: counts of the base kinds, a digest of the base spans, all spans and their number.

    Spans are kind:start:end in code points, end exclusive, by start. A null or empty text has no spans.
    Rows that repeat, null ids and further columns change nothing. Without a ``model`` one is trained on
    the same documents.
    """
    model = model or train(docs, slice_bytes=slice_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", slice_bytes):
            counts, digests, listed, numbers = [], [], [], []
            for text in batch.column("text").to_pylist():
                base, every = spans_of(text or "", model)
                kinds = Counter(k for _, _, k in base)
                counts.append([kinds[k] for k in BASE])
                digests.append(hashlib.sha256(_listed(base).encode()).hexdigest())
                listed.append(_listed(every))
                numbers.append(len(every))
            columns = [pa.array([c[j] for c in counts], pa.int64()) for j in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns, pa.array(digests, pa.string()), pa.array(listed, pa.string()), pa.array(numbers, pa.int64())], ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_spans bigint")


def redact(text: str | None, model: SpanModel) -> str | None:
    """The text with each span, or stretch of overlapping spans, replaced by its first kind in brackets."""
    if not text:
        return text
    out, at = [], 0
    for a, b, kind in spans_of(text, model)[1]:
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact_personal_data(docs: DataFrame, model: SpanModel | None = None, *, slice_bytes: int = 8 << 20) -> DataFrame:
    """``docs`` with the spans of ``text`` redacted and ``n_chars``, where there is one, counted anew.

    All rows and columns stay; a null text stays null.
    """
    model = model or train(docs, slice_bytes=slice_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", slice_bytes):
            clean = pa.array([redact(t, model) for t in batch.column("text").to_pylist()], batch.schema.field("text").type)
            columns = [clean if n == "text" else batch.column(i) for i, n in enumerate(batch.schema.names)]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
