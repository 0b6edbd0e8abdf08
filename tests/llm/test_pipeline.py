"""The stages on a small corpus: each decision takes effect and clean documents stay."""

import re

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from gridloom.llm.byte_bpe import read_ranks


def test_stages_over_the_smallest_tables(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = corpus_pipeline.run(spark, folder).cache()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "personal_data", "tokens"]
    assert set(docs.columns) <= set(out.columns)
    assert out.select("doc_id").distinct().count() == out.count() < docs.count()
    assert out.where("decoded <> text or n_tokens <> size(ids)").count() == 0
    assert out.where("text rlike '[a-z0-9.]+@[a-z0-9]+[.](com|org)'").count() == 0


def test_near_duplicates_at_eight_tenths(spark):
    """Copies of 0.82 go with those of 0.98, one of 0.79 stays."""
    words = [f"w{i}" for i in range(1004)]  # 1,000 shingles
    copy = lambda n, tag: " ".join([tag + w if i < n else w for i, w in enumerate(words)])
    texts = [copy(0, ""), copy(99, "a"), copy(117, "b"), copy(10, "c")]  # 901 / 1099, 883 / 1117, 990 / 1010
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    stage = dict(corpus_pipeline.STAGES)["near_duplicates"]
    assert sorted(r.doc_id for r in stage(spark, docs, "").collect()) == [0, 2]


FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
STAGES = dict(corpus_pipeline.STAGES)


def rows_of(frame):
    return {r.doc_id: r for r in frame.collect()}


def test_near_duplicates_by_brute_force(spark):
    """Of the documents linked by 0.8 of their shingles, over any number of links, the one of the smallest doc_id stays."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    sets = {}
    for i, t in texts.items():
        w = re.findall(r"[^ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    least = {i: i for i in sets}
    find = lambda i: i if least[i] == i else find(least[i])
    for i in sets:
        for j in sets:
            if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                least[b] = a
    assert set(rows_of(STAGES["near_duplicates"](spark, docs, FOLDER))) == {i for i in sets if find(i) == i}


def test_decontamination_by_brute_force(spark):
    """Documents with a twentieth of their words in passages of the benchmark go, all others stay."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    words = lambda t: re.findall(r"[0-9a-z\x80-\U0010FFFF]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = {}
    for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect():
        w = words(r.text)
        for j in range(max(1, len(w) - 12)) if w else ():
            windows.setdefault(len(w[j : j + 13]), set()).add(tuple(w[j : j + 13]))
    stay = set()
    for r in docs.collect():
        w = words(r.text)
        hit = [False] * len(w)
        for n, own in windows.items():
            for j in range(len(w) - n + 1):
                if tuple(w[j : j + n]) in own:
                    hit[j : j + n] = [True] * n
        if not any(hit) or 20 * sum(hit) < len(w):
            stay.add(r.doc_id)
    assert set(rows_of(STAGES["decontamination"](spark, docs, FOLDER))) == stay < {r.doc_id for r in docs.collect()}


def test_toxicity_by_its_labels(spark):
    """Labelled toxic documents go and clean ones stay, but for a few that the words do not tell."""
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    kept = set(rows_of(STAGES["toxicity"](spark, docs, folder)))
    bad, good = ([i for i, t in toxic.items() if t == k] for k in (1, 0))
    assert sum(i not in kept for i in bad) >= 0.6 * len(bad)
    assert sum(i in kept for i in good) >= 0.98 * len(good)


def test_personal_data_and_tokens_by_brute_force(spark):
    docs = spark.createDataFrame([(1, "Mail a.b@c.de or call +1 (212) 555-0199 now", "en", "s", 44), (2, "plain words", "en", "s", 11), (3, None, None, None, None), (None, "", "en", "s", 0), (2, "plain words", "en", "s", 11)], SCHEMA)
    clean = STAGES["personal_data"](spark, docs, FOLDER)
    assert clean.columns == docs.columns
    assert sorted((r.text or "-", r.n_chars or 0) for r in clean.collect()) == [("-", 0), ("-", 0), ("Mail [EMAIL] or call [PHONE] now", 32), ("plain words", 11), ("plain words", 11)]
    ranks = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    coded = STAGES["tokens"](spark, clean, FOLDER).collect()
    assert len(coded) == 5 and all(r.ids == library.encode_ordinary(r.text or "") and r.decoded == (r.text or "") and r.n_tokens == len(r.ids) for r in coded)


@pytest.mark.parametrize("name", list(STAGES))
def test_stages_on_odd_tables(spark, name):
    """Empty tables, null ids and texts, repeated rows and further columns go through every stage."""
    odd = [(None, None, None, None, None, "x"), (None, "no id", "en", "s", 5, "x"), (5, "one two", "en", "s", 7, "x"), (5, "one two", "en", "s", 7, "x"), (7, "", "en", "s", 0, "x")]
    docs = spark.createDataFrame(odd, SCHEMA + ", toxic string")
    out = STAGES[name](spark, docs, FOLDER)
    assert set(docs.columns) <= set(out.columns)
    assert {(r.doc_id, r.text) for r in out.collect()} == {(i, t) for i, t, *_ in odd}
    assert STAGES[name](spark, docs.limit(0), FOLDER).count() == 0
