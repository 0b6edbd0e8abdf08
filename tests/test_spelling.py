"""Edit distances and near words against a plain table of distances."""

import random

from pyspark.sql import functions as F

from gridloom.operators.spelling import closest, edit_distance, edits, near_pairs, nearest_words


def word(rng, n):
    return "".join(rng.choice("abc") for _ in range(n))


def test_distance_by_the_table(spark):
    assert [edits(a, b) for a, b in (("", ""), ("a", ""), ("ca", "abc"), ("ab", "ba"), ("kitten", "sitting"), ("abcdef", "abdcfe"))] == [0, 1, 3, 1, 3, 2]
    rng = random.Random(3)
    pairs = [(word(rng, rng.randint(0, 9)), word(rng, rng.randint(0, 9))) for _ in range(3_000)] + [("ünï😀", "unï"), ("", "abc"), (None, "a"), ("a", None)]
    got = spark.createDataFrame(pairs, "a string, b string").select("a", "b", edit_distance(F.col("a"), F.col("b")).alias("d")).collect()
    plain = [r for r in got if r.a is not None and r.b is not None and "😀" not in r.a]
    assert all(r.d == edits(r.a, r.b) for r in plain) and len(plain) == 3_001
    assert [r.d for r in got if r.a is None or r.b is None] == [None, None]


def test_near_pairs_by_brute_force(spark):
    rng = random.Random(4)
    left = sorted({word(rng, rng.randint(0, 12)) for _ in range(150)} | {"", "a" * 60, "ab" * 40})
    right = sorted({word(rng, rng.randint(0, 12)) for _ in range(150)} | {"", "a" * 59, "ab" * 39 + "ba", "x" * 60})
    frame = lambda words: spark.createDataFrame([(w,) for w in words], "word string")
    for most in (1, 2):
        got = {(r.word, r.other, r.distance) for r in near_pairs(frame(left), frame(right), most).collect()}
        assert got == {(a, b, edits(a, b)) for a in left for b in right if abs(len(a) - len(b)) <= most and edits(a, b) <= most}


def test_nearest_words(spark):
    df = spark.createDataFrame([(1, "SALRY"), (2, "dpet"), (3, "nothing like it"), (4, None), (5, "name")], "i int, w string")
    names = spark.createDataFrame([("Salary",), ("Dept",), ("Name",), ("Same",), (None,)], "n string")
    assert {r.i: (r.nearest, r.distance) for r in nearest_words(df, "w", names, "n").collect()} == {1: ("salary", 1), 2: ("dept", 1), 3: (None, None), 4: (None, None), 5: ("name", 0)}
    assert closest("salery", ["Dept", "Salary"]) == "Salary" and closest("zzz", ["Dept"]) is None and closest("x", []) is None
