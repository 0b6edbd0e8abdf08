"""The training-data operators against brute force, with nulls, empty and long texts, ties and odd columns."""

import base64
import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from gridloom.llm.byte_bpe import Codec, decode, encode, read_ranks, spread
from gridloom.llm.decontamination import match_benchmark, remove_contaminated
from gridloom.llm.near_duplicates import drop_near_duplicates, link_near_duplicates, parity_bits
from gridloom.llm.order_minhash import fingerprint_edits
from gridloom.llm.pii import base_spans, find_personal_data, redact_personal_data
from gridloom.llm.pitman_yor import score_documents
from gridloom.llm.sentence_spans import remove_repeated_spans, sentences
from gridloom.llm.sharding import best_fit, fit_into, pack_documents
from gridloom.llm.toxicity import drop_toxic, score_toxicity

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, contaminated string"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    """Ordinary, near-copied, null, empty, long, tied and oddly spaced texts."""
    rng = random.Random(3)
    texts = [prose(rng, rng.randint(1, 90)) for _ in range(40)]
    long = prose(rng, 6000)
    for i in (3, 8, 9):
        near = texts[i].split()
        near[len(near) // 2] = "changed"
        texts.append(" ".join(near))
    texts += [texts[5], texts[5], long, long + " tail", None, "", " \t\n ", "one", "x" * 3000, "Ünïcödé ẞ 中文 🙂 naïve space wide", "a  b\r\n c's don't 123 4.5!!", "Mail a.b@c.de now +1 (212) 555-0199 or 4111 1111 1111 1111 at 10.0.0.255"]
    rows = [(i, t, "en", "s", None if t is None else len(t), "clash") for i, t in enumerate(texts)]
    return [*rows, (None, "no id here at all " + texts[2], None, None, None, None), rows[7]]


@pytest.fixture
def docs(spark, corpus):
    return spark.createDataFrame(corpus, SCHEMA).repartition(3)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def codec():
    return Codec(read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)


@pytest.mark.parametrize("frequent", [5, 1000])
def test_bpe_equals_the_library_and_decodes(docs, corpus, frequent):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    small = docs.where("length(text) < 4000 or text is null")
    got = decode(encode(small, codec(), frequent_words=frequent), codec()).collect()
    assert len(got) == sum(t is None or len(t) < 4000 for _, t, *_ in corpus)
    for r in got:
        assert r.ids == library.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()
        assert r.contaminated in ("clash", None)


def test_bpe_of_long_words_and_texts(spark):
    """Words of thousands of characters, runs of one letter, and a text of over 100,000 characters."""
    rng = random.Random(8)
    words = ["".join(rng.choice("etaoin shrdlu"[:6]) for _ in range(3000)), "a" * 2500, "é" * 900, "\n" * 1500, "9" * 700]
    texts = [*words, prose(rng, 24_000) + " " + words[0][:500]]
    assert len(texts[-1]) > 100_000
    ranks = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in decode(encode(frame, codec(), frequent_words=10), codec()).collect():
        assert r.ids == library.encode_ordinary(r.text)
        assert bytes(r.decoded) == r.text.encode()


def test_slots_never_collide():
    keys = np.unique(np.random.default_rng(2).integers(0, 1 << 40, 20_000))
    shifts, slots, size = spread(keys, keys)
    assert len(np.unique(slots)) == len(keys) and slots.max() < size
    assert (slots == (keys % size + shifts[keys % len(shifts)]) % size).all()
    assert spread(keys[:0], keys[:0])[1].size == 0


def test_bpe_of_an_empty_table(none):
    assert decode(encode(none, codec()), codec()).count() == 0


def brute_personal(text):
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    card, phone = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
    out = []
    for k, (name, pattern) in enumerate((("email", email), ("ip", ip), ("card", card), ("phone", phone))):
        for m in pattern.finditer(text):
            digits = re.sub(r"\D", "", m[0])
            luhn = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(digits[::-1])) % 10 == 0
            if name == "ip" and max(map(int, m[0].split("."))) > 255:
                continue
            if name == "card" and not (14 <= len(digits) <= 19 and luhn):
                continue
            if name == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end(), name))
    return [(a, b, n) for a, _, b, n in sorted(out)]


HOSTILE = ["a@b@c.d", "@x.y@z.w", "a@b.c@d.e", "..%@a-b.c.d-", "1.2.3.4.5", "256.1.1.1", "0000.001.02.3", "00000000255.1.1.1", "+1 (212) 555-0199.", "4111-1111-1111-1111", "4111 1111  1111 1111", "++1 22222 33333", "é@é.fr x@y.é a@b.c"]


@pytest.mark.parametrize("text", HOSTILE)
def test_base_spans_on_hostile_texts(text):
    assert base_spans(text) == brute_personal(text)


@pytest.mark.parametrize("n", [1, 50, 1000])
def test_secrets_are_found_at_every_size(spark, n):
    """Tokens after their name are spans, sixteen digits that are no card are none, however many rows there are."""
    rng = random.Random(n)
    number = lambda: "4" + "".join(rng.choice("0123456789") for _ in range(14))
    failing = lambda d: next(d + c for c in "0123456789" if not brute_personal(d + c))
    token = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40))
    rows, want = [], {}
    for i in range(n):
        before, t = prose(rng, 20), token()
        text = f'{before} token = "{t}" {prose(rng, 9)} {failing(number())} {prose(rng, 3)}' if i % 10 == 0 else prose(rng, 30)
        want[i] = f"secret:{len(before) + 10}:{len(before) + 50}" if i % 10 == 0 else ""
        rows.append((i, text))
    got = find_personal_data(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: r.spans for r in got} == want
    assert all(r.n_spans == bool(want[r.doc_id]) for r in got)


def test_many_candidates_in_one_text(spark):
    text = " ".join(f"key{i:05d}abcdefghij{i * 7919:010d}" for i in range(20_000))
    row = find_personal_data(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert row.n_spans > 0


def test_personal_data(docs, corpus, none):
    texts = {r[0]: r[1] or "" for r in corpus}
    rows = find_personal_data(docs).collect()
    assert len(rows) == len(corpus)
    for r in rows:
        spans = brute_personal(texts[r.doc_id])
        listed = ",".join(f"{k}:{a}:{b}" for a, b, k in spans)
        assert r.base_sha256 == sha(listed)
        assert all(x in r.spans.split(",") for x in listed.split(","))
    assert sum(r.n_email for r in rows) == 1 and sum(r.n_phone for r in rows) == 1
    assert find_personal_data(none).count() == 0
    clean = {r.doc_id: r for r in redact_personal_data(docs).collect()}
    mail = next(i for i, t in texts.items() if t.startswith("Mail"))
    assert clean[mail].text == "Mail [EMAIL] now [PHONE] or [CARD] at [IP]" and clean[mail].n_chars == len(clean[mail].text)
    assert sum(r.text is None for r in clean.values()) == 1 and clean[0].contaminated == "clash"


def test_language_model(docs, corpus, none):
    counts, held = collections.Counter(), {}
    for i, t, *_ in corpus:
        held[i] = zlib.crc32(str("" if i is None else i).encode()) % 5 == 1
        if not held[i]:
            counts.update((t or "").encode().lower().split() + [b"\n"])
    n, v = sum(counts.values()), len(counts)
    rows = score_documents(docs).collect()
    assert len(rows) == len(corpus)
    texts = {r[0]: r[1] or "" for r in corpus}
    for r in rows:
        words = texts[r.doc_id].encode().lower().split() + [b"\n"]
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(words), sum(w in counts for w in words), n)
        assert r.base_score == pytest.approx(base, rel=1e-6) and r.score < 0
    assert score_documents(none).count() == 0
    only = docs.where("doc_id is null or doc_id = 0")
    assert score_documents(only.where("doc_id = 1")).count() == 0


def shingles(text, k=5):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute_links(rows, percent=85):
    sets = [(i, shingles(t)) for i, t, *_ in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                lo, hi = sorted((root(i), root(j)))
                parent[hi] = lo
    return {i: root(i) for i, _ in sets}


def family(rng, n, size=120, edits=4):
    """A large group of copies with edits, of which some are alike enough and some only by way of others."""
    base = [f"w{rng.randint(0, 5000)}" for _ in range(size)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randint(0, edits)):
            own[rng.randrange(size)] = f"e{rng.randint(0, 10**6)}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("small_bucket", [2, 48])
def test_near_duplicates(spark, corpus, small_bucket):
    rng = random.Random(11)
    rows = [*corpus, *[(1000 + i, t, "en", "s", 1, "x") for i, t in enumerate(family(rng, 90))]]
    frame = spark.createDataFrame(rows, SCHEMA)
    expected = brute_links(rows)
    got = link_near_duplicates(frame, small_bucket=small_bucket).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.component_id == expected[r.doc_id] and r.kept == (r.doc_id == r.component_id)
    kept = {r.doc_id for r in drop_near_duplicates(frame).collect()}
    assert kept == {i for i, c in expected.items() if i == c} | {None}


def test_near_duplicates_of_an_empty_table(none):
    assert link_near_duplicates(none).count() == 0


def test_parity_bits_never_exceed_the_difference():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 3000, rng.integers(1, 900))).astype(np.uint64) for _ in range(30)]
    bits = np.unpackbits(parity_bits(sets).view(np.uint8), axis=1)
    for a, x in zip(sets, bits):
        for b, y in zip(sets, bits):
            assert (x != y).sum() <= len(np.setxor1d(a, b))


def words_only(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))


def test_decontamination(spark, docs, corpus, none):
    rng = random.Random(5)
    texts = {r[0]: r[1] for r in corpus}
    items = [(1, texts[43][100:400]), (2, "one"), (2, prose(rng, 20)), (10, texts[3]), (20, " ".join(texts[43].split()[10:40])), (21, " ".join(texts[43].split()[30:70])), (11, None), (12, ""), (None, "alpha"), (13, " ".join(texts[4].split()[:9]).upper())]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    windows = []
    for i, t in items:
        w = words_only(t)
        if i is not None and w:
            windows += [(str(i), w[j : j + 13]) for j in range(max(1, len(w) - 12))]
    for blocks in (1 << 20, 64):
        rows = match_benchmark(docs, bench, block_bytes=blocks, shard_bytes=3000).collect()
        assert len(rows) == len(corpus)
        for r in rows:
            w = words_only(texts[r.doc_id])
            hit, found = [False] * len(w), set()
            for i, x in windows:
                for at in range(len(w) - len(x) + 1):
                    if w[at : at + len(x)] == x:
                        hit[at : at + len(x)] = [True] * len(x)
                        found.add(i)
            assert (r.n_words, r.n_hit, r.n_items) == (len(w), sum(hit), len(found))
            assert r.items_sha256 == sha(",".join(sorted(found)))
            assert r.contaminated == (sum(hit) > 0 and 20 * sum(hit) >= len(w))
            best = (0, None, None)
            for i, t in items:
                x = words_only(t)
                for at in range(len(w)):
                    for q in range(len(x)) if i is not None and x else ():
                        n = 0
                        while at + n < len(w) and q + n < len(x) and w[at + n] == x[q + n]:
                            n += 1
                        if n >= min(13, len(x)) and (-n, at, str(i)) < (-best[0], best[1] if best[1] is not None else at + 1, best[2] or ""):
                            best = (n, at, str(i))
            assert (r.longest_match, r.longest_start, r.longest_item) == best
    kept = remove_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert kept.count() == sum(not r.contaminated for r in rows)
    assert match_benchmark(none, bench).count() == 0 and match_benchmark(docs, bench.limit(0)).where("n_hit > 0").count() == 0


@pytest.mark.parametrize("buckets", [1, 7])
def test_fingerprints(docs, corpus, none, buckets):
    ordered = sorted(((i, t or "") for i, t, *_ in corpus), key=lambda x: (x[0] is None, -(x[0] or 0), x[1]))
    expected = collections.Counter()
    for (i, t), (_, u) in zip(ordered, ordered[1:] + ordered[:1]):
        cut = len(t) // 3
        expected[(i, len(t), sha(t[: len(t) - cut] + u[:cut]))] += 1
    rows = fingerprint_edits(docs, buckets=buckets).collect()
    assert collections.Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in rows) == expected
    texts = {r[0]: r[1] or "" for r in corpus}
    by_text = collections.defaultdict(set)
    for r in rows:
        by_text[texts[r.doc_id]].add(r.fingerprint)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert max(map(len, by_text.values())) == 1
    long = [r for r in rows if len(texts[r.doc_id]) > 200 and "xxx" not in texts[r.doc_id]]
    assert sum(r.near_edited for r in long) > sum(r.near_next for r in long)
    assert fingerprint_edits(none).count() == 0


def brute_fingerprint(text, k=3, tuples=20, width=2):
    """Order MinHash in plain Python, with Spark's hashes."""
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    h64 = lambda data, seed: xxhash.xxh64(data, seed=seed % (1 << 64)).intdigest()
    of_long = lambda x, seed=42: h64((x % (1 << 64)).to_bytes(8, "little"), seed)
    of_int = lambda x, seed: h64(x.to_bytes(4, "little"), seed)
    words = [w.encode() for w in re.split("[\x20\x09-\x0D]+", text) if w]
    kmers = []
    for i in range(len(words) - k + 1):
        h = 42
        for w in words[i : i + k]:
            h = h64(w, h)
        kmers.append(h)
    kmers = kmers or [h64(b" ".join(words), 42)]
    seen, numbered = collections.Counter(), []
    for at, h in enumerate(kmers):
        numbered.append((of_int(seen[h], of_long(h)), at))
        seen[h] += 1
    least = [min((signed(of_int(j, of_long(x)) >> 31 << 31), at) for x, at in numbered) for j in range(tuples * width)]
    out = []
    for t in range(tuples):
        h = 42
        for _, x in sorted((at, x % (1 << 64) >> 31) for x, at in least[t * width : (t + 1) * width]):
            h = of_long(x, h)
        out.append(f"{h:x}")
    return " ".join(out)


def test_fingerprints_by_brute_force(docs, corpus):
    texts = {r[0]: r[1] or "" for r in corpus}
    for r in fingerprint_edits(docs).collect():
        if texts[r.doc_id].split():
            assert r.fingerprint == brute_fingerprint(texts[r.doc_id])


def test_fingerprints_tell_order_and_repetition(spark):
    a = " ".join(WORDS)
    texts = [a, " ".join(WORDS[10:] + WORDS[:10]), a + " " + a, a + " " + a + " " + a]
    rows = fingerprint_edits(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    assert len({r.fingerprint for r in rows}) == 4


def test_packing(docs, corpus, none):
    assert best_fit([6, 5, 4, 3, 2], 10) == [0, 1, 0, 1, 1]
    even = fit_into([5, 4, 3, 3, 2, 1], 2)
    assert [sum(s for s, b in zip([5, 4, 3, 3, 2, 1], even) if b == k) for k in (0, 1)] == [9, 9]
    rows = pack_documents(docs).collect()
    assert len(rows) == len(corpus)
    texts = {r[0]: r[1] for r in corpus}
    slots, homes = collections.defaultdict(list), collections.defaultdict(set)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        slots[r.shard].append(r.slot)
        homes[texts[r.doc_id]].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and max(map(len, homes.values())) == 1
    fixed = pack_documents(docs, shards=None, capacity=5000).groupBy("shard").agg(F.sum("size").alias("s"), F.count("*").alias("n")).collect()
    assert all(r.s <= 5000 or r.n == 1 for r in fixed)
    assert pack_documents(none).count() == 0


def test_packing_beats_half_full_bins():
    rng = random.Random(2)
    sizes = sorted((rng.randint(1, 60) for _ in range(2000)), reverse=True)
    bins = best_fit(sizes, 100)
    assert max(bins) + 1 <= 1.02 * sum(sizes) / 100 + 1
    held = collections.Counter()
    for b, s in zip(bins, sizes):
        held[b] += s
    assert max(held.values()) <= 100


def test_sentence_spans(spark, none):
    rng = random.Random(9)
    passage = ". ".join(prose(rng, 14) for _ in range(5)) + ". "
    own = [". ".join(f"own{i} {prose(rng, 11)} {rng.random()}" for _ in range(3)) + ".\n" for i in range(6)]
    texts = [own[0], own[1] + passage + own[2], passage + own[3], own[4] + passage, own[5], None, "", "Short line.\n" + own[0][:0] + "Short line.\n", own[4] + passage]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in remove_repeated_spans(rows).collect()}
    assert len(got) == len(texts)
    assert got[0].text == texts[0] and got[1].text == texts[1]
    assert got[2].text == own[3] and got[3].text == own[4]
    assert got[5].text is None and got[6].text == "" and got[7].text == texts[7] and got[8].text == ""
    assert all("".join(sentences(t)) == t for t in texts if t)
    assert remove_repeated_spans(none).count() == 0


def test_passages_of_words_by_brute_force(spark):
    """Every window of 51 words but its first occurrence goes, wherever sentences end; other words stay."""
    rng = random.Random(12)
    vocabulary = [a + b for a in WORDS for b in WORDS]
    some = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    long, mid, edge, short = some(101), some(82), some(51), some(50)
    texts = [long, long, f"{some(9)} {mid} {some(40)}", f"{some(60)}, {mid.upper()} {some(5)}", f"{some(30)} {edge}", f"{edge} {some(30)}", f"{short} {some(9)}", f"{some(9)} {short}"]
    texts += [f"{some(20)} {long[len(long) // 3:]} {mid} {some(3)}", " ".join(["again and"] * 90), f"{some(70)} ", None, "", "İ " + long, f"{some(8)}. Then {mid.replace(' ', ', ')}. {some(8)}."]
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    seen, want = {}, {}
    for i, t in enumerate(texts):
        w = words(t)
        stay = [True] * len(w)
        for p in range(len(w) - 50):
            d, q = seen.setdefault(tuple(w[p : p + 51]), (i, p))
            for x in range(max(p, q + 51) if d == i else p, p + 51):
                stay[x] = (d, q) == (i, p) and stay[x]
        want[i] = [x for x, s in zip(w, stay) if s]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    got = {r.doc_id: r for r in remove_repeated_spans(frame).collect()}
    assert {i: words(r.text) for i, r in got.items()} == want
    assert want[1] == [] and got[1].text == "" and len(want[3]) == 65 and len(want[5]) == 30 and len(want[7]) == 59 and len(want[9]) == 51
    assert all(r.removed_chars == len(texts[i] or "") - len(r.text or "") and (r.n_removed > 0) == (r.removed_chars > 0) for i, r in got.items())
    assert all(got[i].text == texts[i] for i in (0, 2, 4, 6, 7, 10, 11, 12))


def test_toxicity(spark, none):
    rng = random.Random(4)
    bad = ["vile", "nasty"]
    rows, labels = [], []
    for i in range(400):
        w = prose(rng, 40).split()
        toxic = i % 5 == 0
        if toxic:
            w[rng.randrange(40)] = rng.choice(bad)
        junk = i % 7 == 0
        rows.append((i, " ".join(x + ("###" if junk else "") for x in w)))
        if i % 2 == 0:
            labels.append((i, int(not junk), int(toxic), "extra"))
    rows += [(400, None), (401, ""), (None, "vile nasty " + prose(rng, 30))]
    labels += [(None, 1, 1, "x"), (1, None, 1, "x"), (9999, 1, 1, "x")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int, text string")
    got = {r.doc_id: r for r in score_toxicity(frame, marks).collect()}
    assert len(got) == len(rows)
    unseen = [i for i in range(400) if i % 2]
    assert sum(got[i].toxic == (i % 5 == 0) for i in unseen) / len(unseen) > 0.97
    assert sum((got[i].p_low_quality > 0.5) == (i % 7 == 0) for i in unseen) / len(unseen) > 0.97
    assert not got[400].toxic and not got[401].toxic and got[None].toxic
    kept = drop_toxic(frame, marks)
    assert kept.columns == frame.columns and kept.where("doc_id is null").count() == 0
    assert score_toxicity(none, marks).count() == 0
    assert score_toxicity(frame, marks.limit(0)).where("toxic").count() == 0


def test_vocabularies_with_ids_beyond_17_bits_are_refused():
    pieces = {bytes([i]): i for i in range(256)}
    with pytest.raises(ValueError, match="140000"):
        Codec(pieces | {b"ab": 140_000}, public_tokenizers.PATTERN)
    Codec(pieces | {b"ab": 131_070}, public_tokenizers.PATTERN)
