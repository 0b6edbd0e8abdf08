"""Seatings of the Pitman-Yor model against enumeration and exact conditional distributions."""

import math

import numpy as np
import pytest

from gridloom.llm.pitman_yor import Bucket, Root, Strengths, _pack, _planes, reseat


def partitions(n):
    """Sizes of the tables of every way to seat n customers."""
    found = [[1]]
    for _ in range(n - 1):
        found = [p[:i] + [p[i] + 1] + p[i + 1 :] for p in found for i in range(len(p))] + [p + [1] for p in found]
    return found


def test_tables_follow_the_enumerated_conditional():
    n, others, parent, d, s = 6, 3, 0.3, 0.6, 2.0
    odds = np.zeros(n + 1)
    for sizes in partitions(n):
        opened = math.prod((s + d * (others + i)) * parent for i in range(len(sizes)))
        odds[len(sizes)] += opened * math.prod(k - d for size in sizes for k in range(1, size))
    many = 60_000
    drawn = reseat(np.full(many, n), np.full(many, others), np.full(many, parent), d, s, np.random.default_rng(1))
    assert np.abs(np.bincount(drawn, minlength=n + 1) / many - odds / odds.sum()).max() < 0.01


def test_tables_of_many_customers_come_near_the_exact_distribution():
    n, others, parent, d, s = 400, 5000, 0.01, 0.7, 5.0
    weights = np.array([0.0])
    for i in range(n):
        t = np.arange(len(weights))
        with np.errstate(divide="ignore"):
            stay = np.append(weights + np.log(np.maximum(i - d * t, 0)), -np.inf)
        weights = np.logaddexp(stay, np.append(-np.inf, weights))
    t = np.arange(n + 1)
    logs = weights + np.append(0, np.cumsum(np.log((s + d * (others + t[:-1])) * parent)))
    p = np.exp(logs - logs.max())
    p /= p.sum()
    mean = (p * t).sum()
    drawn = reseat(np.full(20_000, n), np.full(20_000, others), np.full(20_000, parent), d, s, np.random.default_rng(1))
    assert drawn.mean() == pytest.approx(mean, rel=0.03)
    assert drawn.std() == pytest.approx(math.sqrt((p * (t - mean) ** 2).sum()), rel=0.1)


def test_none_and_single_customers_have_no_choice():
    assert reseat(np.array([0, 1]), np.array([4, 4]), np.array([0.1, 0.1]), 0.7, 5.0, np.random.default_rng(1)).tolist() == [0, 1]


def test_probabilities_add_up_to_one_in_every_context_after_every_sweep():
    rng = np.random.default_rng(2)
    words, before, none = 30, 8, np.zeros(0, np.uint64)
    counts = rng.poisson(1.5, words * before) * rng.integers(0, 2, words * before)
    names = np.arange(words, dtype=np.uint64)
    cells = _pack(np.diff(np.arange(words * before), prepend=0), counts, names, _planes(np.arange(before, dtype=np.uint64)))
    b, strengths = Bucket(0, cells, None, none), Strengths()
    for number in range(4):
        learnt, vocabulary, customers, tables = b.sums(0)
        root = Root(strengths, none, *[np.zeros(0, np.int64)] * 3, customers, tables, learnt, vocabulary)
        guests, seated = b.shares()
        seen = b.learnt[b.word] > 0
        total = np.bincount(b.k, b.predictive(root, guests, seated) * seen, before)
        unseen = root.probabilities(np.zeros(1), np.zeros(1))[0]
        d, s = strengths.discounts[0], strengths.concentrations[0]
        assert total + (s + d * seated) * unseen / (s + guests) == pytest.approx(np.ones(before))
        assert ((b.t >= (b.c > 0)) & (b.t <= b.c)).all()
        b = Bucket(0, cells, b.seats(), none)
        b.sweep(number, root, seated)
