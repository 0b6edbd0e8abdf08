"""Hard negatives, quality and resampling against brute force, with nulls, ties, repeats, odd columns and empty tables."""

import glob
import hashlib
import math
import os
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.llm import queries as llm
from gridloom.llm.hard_negatives import mine_hard_negatives, sliced_scores
from gridloom.llm.quality import WIDTH, Attention, fit_attention, passages, score_quality
from gridloom.llm.resampling import chunks, resample

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op13_importance_resampling"])
def test_sql(spark, name):
    con = duckdb.connect()
    for p in glob.glob(f"{FOLDER}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    want = con.sql(llm.oracle_sql()[name])
    have = llm.queries()[name](spark, FOLDER).select(*want.columns)
    assert sorted(map(tuple, have.collect()), key=repr) == sorted(want.fetchall(), key=repr)


# hard negatives


def brute_negatives(rows, anchor_every=50, positives=5, negatives=3, low=50, high=95):
    kept = []
    for vec_id, vector, label in rows:
        if None in (vec_id, vector, label) or any(x is None or not math.isfinite(x) or abs(x) >= 4096 for x in vector):
            continue
        kept.append((vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label, [math.floor(256 * x) for x in vector]))
    out = []
    for a, label, v in kept:
        if a % anchor_every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), b, other) for b, other, w in kept if b != a)
        for s, b, _ in [r for r in scored if r[2] == label][:positives]:
            hard = [r for r in scored if r[2] != label and low * -s <= 100 * -r[0] <= high * -s][:negatives]
            out += [(a, b, i + 1, c, -s, -t) for i, (t, c, _) in enumerate(hard)]
    return sorted(out)


def vectors(rng, n, length=12):
    rows = [(i, [rng.gauss(0, 0.4) for _ in range(length)], rng.randrange(3)) for i in range(n)]
    rows += [(n + i, list(rows[3][1]), rng.randrange(3)) for i in range(20)]  # a group of copies: ties
    rows += [(None, rows[0][1], 1), (n + 30, None, 1), (n + 31, rows[0][1], None), (n + 32, [None] + rows[0][1][1:], 1)]
    rows += [(n + 33, [math.nan] * length, 1), (n + 34, [math.inf] + rows[0][1][1:], 1), (n + 35, [], 1), (n + 36, rows[0][1][:4], 2), (n + 37, [5000.0] * length, 1)]
    rows += [rows[10], rows[10], rows[0], (50, rows[1][1], 2)]  # repeated rows, and an anchor's id with another vector
    return rows


@pytest.mark.parametrize("block_rows", [2048, 3])
def test_hard_negatives_by_brute_force(spark, block_rows):
    rows = vectors(random.Random(11), 230)
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").withColumns({c: F.lit("x") for c in ("row", "v", "anchor", "score", "place")})
    have = sorted(map(tuple, mine_hard_negatives(df.repartition(5), block_rows=block_rows).collect()))
    assert have == brute_negatives(rows) and len(have) > 20


def test_hard_negatives_of_nothing(spark):
    schema = "vec_id bigint, embedding array<float>, label int"
    assert mine_hard_negatives(spark.createDataFrame([], schema)).collect() == []
    assert mine_hard_negatives(spark.createDataFrame([(50, [1.0], 1)], schema)).collect() == []
    assert mine_hard_negatives(spark.createDataFrame([(50, [], 1), (51, [], 1), (52, [], 2)], schema)).collect() == [(50, 51, 1, 52, 0, 0)]


def test_intervals_drop_pairs_early_and_no_right_one():
    rng = np.random.default_rng(5)
    anchors, candidates = rng.integers(-200, 200, (6, 32)).astype(float), rng.integers(-200, 200, (500, 32))
    exact = anchors.astype(int) @ candidates.T
    bar, seen = np.sort(exact, 1)[:, -4], []

    def can_qualify(i, low, high):
        seen.append(np.broadcast(i, low).size)
        every = exact[i, np.arange(500)] if low.ndim == 2 else None
        assert every is None or ((low <= every) & (every <= high)).all()  # bounds hold at every plane
        return high >= bar[i]

    a, c, score = sliced_scores(anchors, candidates, np.ones((6, 500), bool), can_qualify)
    assert (score == exact[a, c]).all() and sorted(zip(a, c)) == sorted(zip(*np.nonzero(exact >= bar[:, None])))
    assert seen[-1] < 0.2 * seen[0] and seen == sorted(seen, reverse=True)


# quality


def clean(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(n))


def junk(rng, n):
    return " ".join(rng.choice(["buy!!!", "WIN$$", "###", "now!!!"]) for _ in range(n))


def test_gradient_of_the_attention_model():
    rng = np.random.default_rng(2)
    x, starts, label = rng.normal(size=(9, 5)), np.array([0, 4, 5]), np.array([1.0, 0.0, 1.0])
    model = Attention.start(np.zeros(5), np.ones(5), 0.6, 4, 3, 1)
    _, slopes = model.loss_and_slopes(x, starts, label)
    for name, w in model.weights.items():
        for at in np.ndindex(w.shape):
            both = []
            for move in (1e-5, -1e-5):
                kept = w[at].copy()
                w[at] += move
                both.append(model.loss_and_slopes(x, starts, label)[0])
                w[at] = kept
            assert abs((both[0] - both[1]) / 2e-5 - np.asarray(slopes[name])[at]) < 1e-6, name


def test_passages_do_not_depend_on_blocks_or_neighbours():
    rng = random.Random(4)
    texts = ["", None, "  one \n two  ", clean(rng, 300), " \t", "ünï " * 130, "x" * 5000, "same same same"]
    alone = {i: np.concatenate([x for _, x in passages([t], 64)]) for i, t in enumerate(texts)}
    for block in (1, 2, 4096):
        got = {i: [] for i in alone}
        for owner, x in passages(texts, 64, block):
            for o, row in zip(owner, x):
                got[o].append(row)
        for i, want in alone.items():
            assert np.array_equal(np.stack(got[i]), want)
    assert len(alone[3]) == 5 and len(alone[5]) == 3 and alone[0].shape == (1, WIDTH) and not alone[1].any()
    assert alone[7][0, -260:-258].tolist() == [1 - 1 / 3, 2 / 3]


def test_attention_finds_the_bad_passage():
    rng = random.Random(6)
    texts = [clean(rng, 64 * rng.randint(1, 8)) for _ in range(160)]
    bad = [i % 2 for i in range(160)]
    texts = [t + " " + junk(rng, 64) if b else t for t, b in zip(texts, bad)]
    bags = [np.concatenate([x for _, x in passages([t], 64)]) for t in texts]
    model = fit_attention(bags[:120], 1 - np.array(bad[:120], float))
    score = model.scores(texts[120:], 64)
    assert ((score >= 0.5) == 1 - np.array(bad[120:])).mean() >= 0.95
    sure = [i for i in range(120, 160) if bad[i] and len(bags[i]) > 1]
    assert np.mean([model.encoded(model.scaled(bags[i]))[3].argmax() == len(bags[i]) - 1 for i in sure]) >= 0.8
    one = model.encoded(model.scaled(bags[121]))  # the score of one document, by the formula
    a = np.exp(one[3]) / np.exp(one[3]).sum()
    assert abs(1 / (1 + np.exp(-(a @ one[0] @ model.weights["score"] + model.weights["bias"]))) - model.scores([texts[121]], 64)[0]) < 1e-9


def test_quality_on_odd_tables(spark):
    rng = random.Random(8)
    rows = [(i, clean(rng, 80) if i % 3 else junk(rng, 80)) for i in range(120)]
    rows += [(None, None), (200, None), (201, ""), (202, clean(rng, 150_000)), (5, rows[5][1]), (5, rows[5][1])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({c: F.lit("x") for c in ("score", "quality", "bag", "held_out")})
    marks = [(i, 1 if i % 3 else 0) for i in range(120)] + [(None, 1), (7, None), (7, 1)]
    labels = spark.createDataFrame(marks, "doc_id bigint, quality int")
    got = score_quality(df.repartition(3), labels).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows)
    assert all(r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 120]
    assert np.mean([r.predicted == (1 if r.doc_id % 3 else 0) for r in held]) >= 0.9
    assert len({r.score for r in got if r.doc_id == 5}) == 1
    by_text = score_quality(df.withColumn("doc_id", F.concat(F.lit("k"), "doc_id")), labels.withColumn("doc_id", F.concat(F.lit("k"), "doc_id")))
    assert by_text.count() == len(rows)
    assert score_quality(df.limit(0), labels).collect() == []
    assert {r.score for r in score_quality(df, labels.limit(0)).collect()} == {0.5}
    assert {r.score for r in score_quality(df, labels.where("quality = 1")).select(F.round("score", 1).alias("score")).collect()} == {1.0}


def test_quality_held_out(spark):
    folder = "/root/testdata/sf0.01"
    got = llm.op12_quality(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert (got.predicted == got.quality).mean() >= 0.88
    low, high = got[got.quality == 0].score, got[got.quality == 1].score
    assert np.mean([(h > x) + 0.5 * (h == x) for x in low for h in high]) >= 0.95


# resampling


def brute_resample(docs, target, n, buckets, least_words, percent, seed=7):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def features(text):
        w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(fold))
        return len(w), [zlib.crc32(" ".join(w[i : i + k]).encode()) % buckets for k in range(1, n + 1) for i in range(len(w) - k + 1)]

    s, t, own = [0] * buckets, [0] * buckets, [features(x) for _, x in docs]
    for count, texts in ((s, own), (t, [features(x) for x in target])):
        for _, f in texts:
            for b in f:
                count[b] += 1
    gain = [math.floor(1000 * math.log((y + 1) * (sum(s) + buckets) / ((x + 1) * (sum(t) + buckets)))) for x, y in zip(s, t)]
    rows = []
    for (doc, _), (words, f) in zip(docs, own):
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        rows.append([doc, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, words])
    drawn = sorted((r for r in rows if r[5] >= least_words), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for i, r in enumerate(drawn[: percent * len(drawn) // 100]):
        r[4] = i + 1
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("n", [1, 2, 3])
@pytest.mark.parametrize("chunk_bytes", [1 << 16, 40])
def test_resampling_by_brute_force(spark, n, chunk_bytes):
    rng = random.Random(n)
    docs = [(i, clean(rng, rng.randint(0, 60)).title()) for i in range(60)]
    docs += [(None, "a lone id " * 9), (70, None), (71, ""), (72, "... !!"), (73, "x" * 300), (74, clean(rng, 30_000)), (75, "Ünï, cödé; " * 50), (3, docs[3][1]), (3, docs[3][1]), (3, docs[3][1] + " more")]
    target = [clean(rng, 40) for _ in range(5)] + [None, ""]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumns({c: F.lit("x") for c in ("row", "rank", "score", "own", "carried", "weight")})
    other = spark.createDataFrame([(i, x) for i, x in enumerate(target)], "item_id int, text string")
    got = resample(df.repartition(3), other, n=n, buckets=500, least_words=10, percent=30, chunk_bytes=chunk_bytes)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_resample(docs, target, n, 500, 10, 30)


def test_resampling_of_nothing(spark):
    docs, target = spark.createDataFrame([], "doc_id bigint, text string"), spark.createDataFrame([("a b",)], "text string")
    assert resample(docs, target).collect() == []
    got = resample(spark.createDataFrame([("k1", "one two " * 20)], "doc_id string, text string"), target.limit(0), percent=100).collect()
    assert [(r.doc_id, r["rank"]) for r in got] == [("k1", 1)]


def test_chunks_own_every_start_once():
    words = [w.encode() for w in clean(random.Random(1), 400).split()] + [b"y" * 500, b"z"]
    for most in (1, 17, 200, 10_000):
        found = list(chunks(b"  ".join(words), 3, most))
        assert [w for own, _ in found for w in own.split()] == words
        at = 0
        for own, carried in found:
            at += len(own.split())
            assert carried.split() == words[at : at + 2]
