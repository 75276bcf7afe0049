"""Operators on documents against brute force, on whole small tables and on edge cases."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from inquirylake.llm import anchors, bpe, components, licenses, minhash, packing, quality, sharding, substring, suffix
from tests.llm.conftest import texts_of

public_tokenizers = pytest.importorskip("public_tokenizers")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
MODEL = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN
SPLIT = re.compile("[^\x20\x09-\x0d]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def by_id(df):
    rows = df.collect()
    out = {r["doc_id"]: r.asDict() for r in rows}
    assert len(out) == len(rows)
    return out


def test_long_texts(spark):
    """Texts of several hundred thousand characters, one of them one line and one of one word."""
    dice = random.Random(21)
    line = " ".join(f"w{dice.randint(0, 5000)}" for _ in range(60_000))
    rows = [(1, line), (2, "x" * 400_000), (3, line[:200_000]), (4, "license: mit " * 20_000), (5, "ab " * 100_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = by_id(suffix.dedup(df, digest=True))
    assert {i: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for i, r in got.items()} == brute_bytes(rows, 100)
    got = by_id(substring.dedup(df, digest=True))
    assert {i: (r["n_words"], r["n_removed"], r["kept_sha256"]) for i, r in got.items()} == brute_words(rows, 13)
    got = by_id(minhash.near_duplicates(df, 4))
    assert {i: (r["n_shingles"], r["component_id"], r["kept"]) for i, r in got.items()} == brute_near(rows, 4, 80)
    check_packing(packing.pack_documents(df, MODEL, PATTERN).collect(), rows, 2048)
    encoding = __import__("tiktoken").Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.encoder(RANKS).ranks, special_tokens={})
    for i, r in by_id(bpe.token_digests(df, RANKS, PATTERN)).items():
        if i != 2:  # the library takes a word's square
            assert r["n_tokens"] == len(encoding.encode_ordinary(dict(rows)[i]))
    assert {i: r["n_words"] for i, r in by_id(licenses.scan_documents(df)).items()} == {1: 60_000, 2: 1, 3: len(line[:200_000].split()), 4: 40_000, 5: 100_000}
    assert sharding.shard(df).count() == 5


# -- op 1


@pytest.fixture(scope="module")
def reference_encoding():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.encoder(RANKS).ranks, special_tokens={})


def test_bpe_matches_rank_order_merging(reference_encoding):
    dice = random.Random(2)
    letters = "abcé \n\t'sß中😀aa1 2½²\x1c\x85　"
    texts = ["".join(dice.choice(letters) for _ in range(dice.randint(0, 60))) for _ in range(1500)]
    for text in [*texts, "a" * 3000, "ab" * 2000, " " * 500, "\n " * 50 + "x", "x  y", "x \n y", ""]:
        ids = bpe.encode_text(text, RANKS, PATTERN)
        assert np.frombuffer(ids, "<u4").tolist() == reference_encoding.encode_ordinary(text), text
        assert bpe.decode_ids(ids, RANKS) == text.encode()


def test_bpe_small_vocabulary_needs_backtracking():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"bc": 257, b"abc": 258, b"cd": 259, b"bcd": 260}
    encoder = bpe.Encoder(ranks)

    def merge(piece):
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while True:
            found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ranks]
            if not found:
                return [ranks[p] for p in parts]
            i = min(found)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    dice = random.Random(3)
    for _ in range(3000):
        piece = bytes(dice.choice(b"abcd") for _ in range(dice.randint(1, 14)))
        assert encoder.encode(piece) == merge(piece)


@pytest.mark.parametrize("name", ["edge", "small", "empty"])
def test_bpe_rows(request, reference_encoding, name):
    df = request.getfixturevalue(name)
    got = by_id(bpe.token_digests(df, RANKS, PATTERN))
    for doc_id, text in texts_of(df):
        ids = np.array(reference_encoding.encode_ordinary(text), "<u4").tobytes()
        row = got.pop(doc_id)
        assert (row["n_tokens"], row["ids_sha256"], row["decoded_sha256"]) == (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    assert not got


def test_bpe_odd_rows(odd):
    rows = bpe.tokenize(odd, RANKS, PATTERN).collect()
    assert sorted(r["decoded"] for r in rows) == sorted((r["text"] or "").encode() for r in odd.collect())


# -- op 2


def test_quality_ranks_held_out(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality.score(docs, labels)
    assert scored.count() == docs.count()
    rows = scored.join(labels, "doc_id").where("held_out").select("score", "predicted", "quality").collect()
    good = np.array([r["score"] for r in rows if r["quality"] == 1])
    bad = np.array([r["score"] for r in rows if r["quality"] == 0])
    assert len(good) > 100 and len(bad) > 50
    assert (good[:, None] > bad[None]).mean() > 0.98
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.96
    held = [r["doc_id"] for r in scored.where("held_out").collect()]
    assert all(zlib.crc32(str(i).encode()) % 5 == 0 for i in held)


def test_quality_edges(spark, edge, odd, empty):
    labels = spark.createDataFrame([(5, 1, "x"), (16, 0, "x"), (18, 1, "x"), (19, 0, "x"), (5, 1, "x"), (7, None, "x"), (None, 1, "x"), (777, 1, "x")], "doc_id long, quality int, text string")
    none = labels.limit(0)
    for table, docs in ((labels, edge), (none, edge), (labels, odd), (labels, empty)):
        rows = quality.score(docs, table).collect()
        assert len(rows) == docs.count()
        assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    assert {round(r["score"], 9) for r in quality.score(edge, none).collect()} == {0.3}
    assert quality.keep(edge, labels).columns == edge.columns


def test_quality_scores_by_brute_force(spark, small):
    """Learns from the pairs with plain gradient steps, then scores each text by hand."""
    import math

    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    model = quality.train(small, labels)
    known = {r["doc_id"]: r["quality"] for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5}
    texts = dict(texts_of(small))
    taught = [(np.float32(quality.features(texts[i])).astype(float), y) for i, y in sorted(known.items()) if i in texts]
    x = np.array([v for v, _ in taught])
    assert np.allclose(model.mean, x.mean(0)) and np.allclose(model.spread, x.std(0) + 1e-6)
    # at the optimum the mean gradient over all pairs of unlike labels is about that of the ridge
    z = (x - x.mean(0)) / (x.std(0) + 1e-6)
    good, bad = z[[y == 1 for _, y in taught]], z[[y == 0 for _, y in taught]]
    dice = np.random.default_rng(1)
    diff = good[dice.integers(0, len(good), 200_000)] - bad[dice.integers(0, len(bad), 200_000)]
    gradient = -(diff / (1 + np.exp(diff @ model.weights))[:, None]).mean(0) + 1e-3 * model.weights
    assert np.abs(gradient).max() < 5e-3
    for r in quality.score(small, labels).collect():
        plain = np.float32(quality.features(texts[r["doc_id"]])).astype(float)
        raw = sum((v - m) / s * w for v, m, s, w in zip(plain, model.mean, model.spread, model.weights, strict=True))
        score = 1 / (1 + math.exp(-max(-30, min(30, raw - model.cut + math.log(0.3 / 0.7)))))
        assert r["score"] == pytest.approx(score, abs=1e-9) and r["predicted"] == int(r["score"] >= 0.3)


def test_quality_learns_from_all_labelled_rows(spark):
    """More rows than the 40,000 that training once took at most, most of them of one label, in many blocks."""
    from pyspark.sql import functions as F

    texts = [f"word{i} " * (i % 5 + 1) + "!A." * (i % 7) for i in range(500)]
    told = F.array(*map(F.lit, texts))
    docs = spark.range(60_000).select(F.col("id").alias("doc_id"), F.get(told, (F.col("id") * 7919 % 500).cast("int")).alias("text"))
    good = lambda i: int(i % 50 != 0)
    labels = docs.select("doc_id", (F.col("doc_id") % 50 != 0).cast("int").alias("quality"))
    model = quality.train(docs, labels)
    ids = [i for i in range(60_000) if zlib.crc32(str(i).encode()) % 5]
    seen = np.float32([quality.features(t) for t in texts]).astype(float)
    x, bad = seen[[i * 7919 % 500 for i in ids]], np.mean([not good(i) for i in ids])
    assert len(ids) > 40_000 and np.allclose(model.mean, x.mean(0)) and np.allclose(model.spread, x.std(0) + 1e-6)
    assert model.cut == pytest.approx(np.quantile(model.raw(x), 0.97 * bad), abs=1e-9)


def test_quality_pairs_all_rows_in_blocks(spark, small, monkeypatch):
    """Small blocks, so that rows of the rarer label go to several; the optimum is about that of all pairs."""
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    whole = quality.train(small, labels)
    monkeypatch.setattr(quality, "BLOCK", 40)
    blocks = quality.train(small, labels)
    texts = np.array([quality.features(t or "") for _, t in texts_of(small)])
    assert np.corrcoef(whole.raw(texts), blocks.raw(texts))[0, 1] > 0.99 and np.allclose(whole.mean, blocks.mean)


# -- op 3


@pytest.mark.parametrize("name", ["edge", "small", "empty"])
def test_license_rows(request, name):
    df = request.getfixturevalue(name)
    got = by_id(licenses.scan_documents(df))
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    for doc_id, text in texts_of(df):
        words = word.findall(text.translate(LOWER))
        places = [(i, label) for phrase, label in licenses.BASE.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
        starts = [i for i, _ in places]
        row = got.pop(doc_id)
        assert (row["n_words"], row["n_base"], row["first_word"], row["last_word"]) == (len(words), len(places), min(starts, default=None), max(starts, default=None))
        assert row["base_labels"] == ",".join(sorted({label for _, label in places}))
        assert {label for _, label in places} <= set(filter(None, row["labels"].split(",")))
        assert 0 <= row["score"] <= 1
    assert not got


def test_license_expressions(odd):
    assert licenses.postfix("MIT OR Apache-2.0 AND BSD-3-Clause") == ["mit", "apache-2.0", "bsd-3-clause", "and", "or"]
    assert licenses.postfix("(MIT or GPL-2.0) and ISC") == ["mit", "gpl-2.0", "or", "isc", "and"]
    assert licenses.evaluate(licenses.postfix("GPL-2.0 WITH Classpath OR MIT")) == ({"gpl", "mit"}, True)
    assert licenses.evaluate(licenses.postfix("GPL-2.0 AND MIT")) == ({"gpl", "mit"}, False)
    for bad in ("", "MIT OR", "(MIT", "MIT)", "MIT Apache-2.0", "AND MIT", "()"):
        with pytest.raises(licenses.Malformed):
            licenses.postfix(bad)
    found = licenses.scan("Released under CC BY-NC 4.0. SPDX-License-Identifier: MIT\n SPDX-License-Identifier: MIT OR OR")
    assert found.labels == {"cc-by-nc", "mit"} and found.expressions == ["mit"] and found.score == 1.0
    assert licenses.scan_documents(odd).count() == 6


def test_license_labels_only_what_is_known():
    found = licenses.scan("My driving license: expired\nSee the sublicense: MIT\nlicense: Foo-1.0 OR MIT-0\nLicense: BSD-3-Clause.")
    assert found.labels == {"mit", "bsd"} and found.unknown == {"expired", "foo-1.0"}
    assert licenses.scan("license: mitten").labels == set() and licenses.scan("license: expired").score == 0.0
    known = ["gpl-2.0-or-later", "gplv3", "lgpl-2.1+", "apache-2.0", "cc-by-nc-sa-4.0", "cc0-1.0", "mit", "bsd-2-clause-patent", "agpl-3.0-only"]
    assert [licenses.family(x) for x in known] == ["gpl", "gpl", "lgpl", "apache", "cc-by-nc-sa", "cc0", "mit", "bsd", "agpl"]


@pytest.mark.parametrize("line", ["some prose words here license: mit and then more ", "license: mit or license: and ", "license: (", "x license: mit\n", "license: mit or "])
def test_license_scans_take_time_in_proportion(line):
    """One line of 4 MB with 10^5 tags and more; a scan that grows with the square takes hours."""
    import time

    took = []
    for size in (1 << 20, 1 << 22):
        text = (line * (size // len(line) + 1))[:size]
        began = time.process_time()
        found = licenses.scan(text)
        took.append(time.process_time() - began)
        assert found.n_words > 0
    assert took[1] < 30 and took[1] < 12 * max(took[0], 0.2)


# -- op 4


def brute_bytes(rows, width):
    seen, out = set(), {}
    for doc_id, text in rows:
        body = text.encode()
        mask = np.zeros(len(body), bool)
        for i in range(len(body) - width + 1):
            part = body[i : i + width]
            if part in seen:
                mask[i : i + width] = True
            seen.add(part)
        runs = int((np.diff(np.r_[0, mask.astype(int)]) == 1).sum())
        out[doc_id] = (len(body), int(mask.sum()), runs, hashlib.sha256(np.frombuffer(body, np.uint8)[~mask].tobytes()).hexdigest())
    return out


def test_longest_previous_factors():
    assert suffix.longest_previous_factors(b"abababab") == [0, 0, 6, 5, 4, 3, 2, 1]
    dice = random.Random(4)
    for _ in range(200):
        text = bytes(dice.choice(b"ab") for _ in range(dice.randint(0, 60)))
        width = dice.choice([1, 2, 3, 5, 8, 9])
        at = np.arange(max(0, len(text) - width + 1))
        first = suffix.first_of_equal(np.frombuffer(text, np.uint8), at, width)
        assert (first != at).tolist() == [n >= width for n in suffix.longest_previous_factors(text)[: len(at)]]


def test_spans_are_decided_by_factors():
    """Factors of places in any order against brute force, and the spans of a chunk that they give."""
    dice = np.random.default_rng(9)
    text = dice.integers(0, 3, 3000).astype(np.uint8)
    at = np.sort(dice.choice(2900, 900, replace=False))
    place = dice.permutation(5000)[:900]
    got = suffix.factors(text, at, place, 40)
    body = text.tobytes()
    for n, (p, x) in enumerate(zip(at, place, strict=True)):
        longest = 0
        for q in at[place < x]:
            size = 0
            while size < 64 and body[p + size : p + size + 1] and body[p + size : p + size + 1] == body[q + size : q + size + 1]:
                size += 1
            longest = max(longest, size)
        assert got[n] == longest
    column = __import__("pyarrow").array
    rows = suffix.pa.table({"key": column([1, 2, 2]), "start": column([0, 0, 300]), "count": column([101, 101, 101]), "body": column([body[:200], body[100:200] + body[:100], body[50:200] + body[:50]])})
    found = suffix._chunk(rows, np.array([True, True, True]), 100).to_pylist()
    assert [(r["key"], r["start"], r["size"]) for r in found if not r["left"]] == [(2, 0, 100), (2, 100, 100), (2, 300, 200)]


def test_factors_end_with_their_source():
    """Bytes that follow a source only because another slice lies behind it are no part of a factor."""
    x = np.random.default_rng(2).integers(0, 256, 150).astype(np.uint8).tobytes()
    other = b"q" + bytes(range(200))
    column = suffix.pa.array
    bodies = [x, other, x + b"q" + x[::-1]]
    rows = suffix.pa.table({"key": column([1, 2, 3]), "start": column([0, 0, 0]), "count": column([len(b) - 99 for b in bodies]), "body": column(bodies)})
    assert [(r["key"], r["start"], r["size"]) for r in suffix._chunk(rows, np.zeros(3, bool), 100).to_pylist()] == [(3, 0, 150)]


@pytest.mark.parametrize(("name", "width", "hot", "chunk"), [("edge", 100, suffix.HOT, suffix.CHUNK), ("small", 100, 3, 2000), ("edge", 40, 1, 100), ("empty", 100, suffix.HOT, suffix.CHUNK)])
def test_suffix_rows(request, name, width, hot, chunk):
    df = request.getfixturevalue(name)
    got = by_id(suffix.dedup(df, width, True, hot, chunk))
    expected = brute_bytes(texts_of(df), width)
    assert {i: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for i, r in got.items()} == expected


def test_suffix_every_period(spark):
    """Texts of one period stand alone, or have only equal copies, so nothing else brings them up."""
    dice = random.Random(12)
    rows = []
    for period in range(1, 101):
        unit = "".join(dice.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(period))
        text = (unit * 500)[: dice.randint(100 + period, 500)]
        rows += [(period, text)] + [(1000 + period, text)] * (period % 3 == 0)
    got = by_id(suffix.dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), digest=True))
    assert {i: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for i, r in got.items()} == brute_bytes(rows, 100)


def test_suffix_odd_rows(odd):
    rows = suffix.dedup(odd, 20).collect()
    assert len(rows) == 6
    assert [r["n_removed"] for r in rows if r["doc_id"] == 1] == [0, 0]


# -- op 5


def brute_near(rows, size, percent):
    sets = {}
    for doc_id, text in rows:
        words = SPLIT.findall(text.translate(LOWER))
        sets[doc_id] = frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


@pytest.mark.parametrize(("name", "size", "block"), [("edge", 4, 1024), ("small", 4, 1024), ("small", 5, 2), ("empty", 4, 1024)])
def test_minhash_rows(request, monkeypatch, name, size, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    df = request.getfixturevalue(name)
    got = by_id(minhash.near_duplicates(df, size))
    assert {i: (r["n_shingles"], r["component_id"], r["kept"]) for i, r in got.items()} == brute_near(texts_of(df), size, 80)


def test_minhash_chain_beyond_the_hub(spark):
    """Each text is near the next one only; hub comparisons alone would leave the chain in parts."""
    dice = random.Random(9)
    words = [f"u{i}" for i in range(200)]
    rows, text = [], words[:]
    for i in range(40):
        rows.append((i * 7 % 40, " ".join(text)))
        text = text[:]
        text[(i * 23) % 200] = f"n{i}"
        text[(i * 41 + 7) % 200] = f"m{i}"
        dice.shuffle(rows)
    got = by_id(minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4))
    assert {i: (r["n_shingles"], r["component_id"], r["kept"]) for i, r in got.items()} == brute_near(sorted(rows), 4, 80)


def test_estimate_is_close():
    dice = np.random.default_rng(1)
    shared = dice.integers(0, 1 << 62, 900).astype(np.uint64)
    a, b = (np.unique(np.concatenate([shared, dice.integers(0, 1 << 62, 100).astype(np.uint64)])) for _ in range(2))
    truth = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    guess = float(minhash.estimate(minhash.pack(minhash.signature(a)), minhash.pack(minhash.signature(b))))
    assert abs(guess - truth) < 5 * minhash.error(truth)


def test_minhash_odd_rows(odd):
    rows = minhash.near_duplicates(odd).collect()
    assert len(rows) == 6
    assert all(r["kept"] for r in rows if r["doc_id"] is None)
    assert len(minhash.keep_first(odd).where("doc_id = 1").collect()) == 1


def test_minhash_links_by_any_text_of_an_id(spark):
    """Classes that share a doc_id are one document, also where it isn't the smallest of either."""
    dice = random.Random(17)
    say = lambda n: " ".join(dice.choice("abcdefgh") + str(dice.randint(0, 99)) for _ in range(n))
    a, b = say(40), say(40)
    rows = [(3, a), (7, a), (7, b), (9, b), (11, say(40))]
    got = sorted((r["doc_id"], r["component_id"]) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(3, 3), (7, 3), (7, 3), (9, 3), (11, 11)]


def test_keep_first_keeps_unlike_texts_and_columns_of_any_name(spark, edge):
    rows = [(1, "one two three four five six", 5), (1, "one two three four five six", 5), (1, "seven eight nine ten eleven twelve", 6), (None, None, 7)]
    kept = minhash.keep_first(spark.createDataFrame(rows, "doc_id long, text string, _row int").withColumn("kept_", __import__("pyspark").sql.functions.lit(1)))
    assert kept.columns == ["doc_id", "text", "_row", "kept_"]
    assert sorted(r["_row"] for r in kept.collect()) == [5, 6, 7]
    assert minhash.keep_first(edge).columns == edge.columns


@pytest.mark.parametrize("least", [1, 3])
def test_hot_keys_change_nothing(monkeypatch, small, least):
    """Every repeated key counts as hot, and buckets are cut small."""
    from inquirylake.llm import common

    monkeypatch.setattr(common, "HOT", least)
    monkeypatch.setattr(common, "MOST_HOT", 10**6)
    monkeypatch.setattr(minhash, "BLOCK", 3)
    got = by_id(minhash.near_duplicates(small, 4))
    assert {i: (r["n_shingles"], r["component_id"], r["kept"]) for i, r in got.items()} == brute_near(texts_of(small), 4, 80)
    got = by_id(substring.dedup(small, digest=True, hot=least))
    assert {i: (r["n_words"], r["n_removed"], r["kept_sha256"]) for i, r in got.items()} == brute_words(texts_of(small), 13)


@pytest.mark.parametrize("few", [0, 1 << 20])
def test_components(spark, few):
    dice = random.Random(8)
    edges = [(i, i + 1) for i in range(50)] + [(200, i) for i in range(201, 260)] + [(dice.randint(300, 400), dice.randint(300, 400)) for _ in range(60)] + [(7, 7), (None, 3)]
    root = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = components.components(spark.createDataFrame(edges, "a long, b long").repartition(3), few)
    assert {r["node"]: r["component"] for r in got.collect()} == {i: find(i) for i in root}


# -- op 7


def brute_words(rows, width):
    first, out = {}, {}
    for doc_id, text in rows:
        words = SPLIT.findall(text)
        drop = [False] * len(words)
        for i in range(len(words) - width + 1):
            if first.setdefault(tuple(words[i : i + width]), doc_id) < doc_id:
                drop[i : i + width] = [True] * width
        kept = [w for w, d in zip(words, drop, strict=True) if not d]
        out[doc_id] = (len(words), sum(drop), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return out


@pytest.mark.parametrize(("name", "width"), [("edge", 13), ("small", 13), ("edge", 3), ("empty", 13)])
def test_substring_rows(request, name, width):
    df = request.getfixturevalue(name)
    got = by_id(substring.dedup(df, width, digest=True))
    assert {i: (r["n_words"], r["n_removed"], r["kept_sha256"]) for i, r in got.items()} == brute_words(texts_of(df), width)


def test_substring_keeps_columns_and_odd_rows(edge, odd):
    rows = substring.dedup(edge, carry=["source", "key"]).collect()
    assert {r["source"] for r in rows} == {"s"} and {r["key"] for r in rows} == {-1}
    untouched = {r["doc_id"]: r["kept_text"] for r in rows if not r["n_removed"]}
    assert untouched[11] == " \n\t "
    assert substring.dedup(odd).count() == 6


def test_paths_end_where_the_graph_branches(spark):
    """Two passages that share their middle meet and part in it, so there the compacted paths are cut."""
    a, b, c, d, middle = (" ".join(f"{x}{i}" for i in range(20)) for x in "abcdm")
    texts = [(1, f"{a} {middle} {b}"), (2, f"{c} {middle} {d}"), (3, f"{a} {middle} {b}"), (4, f"{c} {middle} {d}"), (5, f"{a} {middle} {d}")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(2)
    keyed = substring.repeats.keyed(docs)
    bodies = substring.common.packed(keyed)
    found = sorted((r["key"], r["start"], r["words"]) for r in substring.paths(keyed, bodies.select("key", "body"), 5).collect())
    whole = {}
    for key, start, words in found:
        whole.setdefault(key, []).append((start, start + words))
    assert set(whole) == {2, 3, 4, 5} and whole[2] == [(20, 40)]
    # text 3 is all of text 1, but its windows at the middle's ends have neighbours in 2 and 5 too
    assert len(whole[3]) > 1 and whole[3][0][0] == 0 and whole[3][-1][1] == 60
    got = by_id(substring.dedup(docs, 5, digest=True))
    assert {i: (r["n_words"], r["n_removed"], r["kept_sha256"]) for i, r in got.items()} == brute_words(texts, 5)


@pytest.mark.parametrize("segment", [40, 64, 1 << 20])
def test_runs_cover_each_window_once(monkeypatch, segment):
    monkeypatch.setattr(anchors, "SEGMENT", segment)
    dice = random.Random(segment)
    for _ in range(80):
        texts = ["".join(dice.choice("ab  \n") for _ in range(dice.randint(0, 150))).encode() for _ in range(dice.randint(0, 5))]
        data, bounds = anchors.joined(texts)
        _, starts, ends, first = anchors.words(data, bounds)
        assert [t.split() for t in texts] == [[data[a:b].tobytes() for a, b in zip(starts[x:y], ends[x:y], strict=True)] for x, y in zip(first[:-1], first[1:], strict=True)]
        found = anchors.runs(data, bounds, 12, 4, anchors.BYTES)
        covered = sorted((t, s + i) for t, s, n in zip(found[2], found[3], found[4], strict=True) for i in range(n))
        assert covered == [(t, i) for t, x in enumerate(texts) for i in range(len(x) - 11)]


# -- op 8


def check_packing(rows, texts, width, added=False):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(MODEL)
    tokenizer.encode_special_tokens = not added  # by default the library reads the markers of added tokens
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == {i for i, _ in texts}
    for doc_id, text in texts:
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for piece in sorted(by_doc[doc_id], key=lambda r: r["start"]):
            assert piece["start"] == at and piece["doc_tokens"] == len(ids) and piece["length"] > 0
            cut = ids[at : at + piece["length"]].tobytes()
            assert piece["ids_crc32"] == zlib.crc32(cut) and piece["ids"] == cut
            at += piece["length"]
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for piece in sorted(pieces, key=lambda r: r["offset"]):
            assert piece["offset"] == at
            at += piece["length"]
        assert at <= width and at & (at - 1) == 0  # full, or of a power of two: no padding


@pytest.mark.parametrize(("name", "width"), [("edge", 2048), ("small", 2048), ("edge", 64), ("empty", 2048)])
def test_packing_rows(request, name, width):
    df = request.getfixturevalue(name)
    check_packing(packing.pack_documents(df, MODEL, PATTERN, width=width).collect(), texts_of(df), width)


def test_packing_query_and_stage_read_added_tokens(spark, tmp_path):
    """As the library reads the file by default: a marker in a text has its own id."""
    from tokenizers import Tokenizer

    import corpus_pipeline
    from inquirylake.llm import queries

    tokenizer = Tokenizer.from_file(MODEL)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x  <|endoftext|><|endoftext|>\n\n y", "<|endoftext", "<|<|endoftext|>|>", "it's  plain"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    expected = {}
    for i, text in enumerate(texts):
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 1], "<u4")
        expected[i] = (len(ids), ids.tobytes())
    assert expected[0][1] == np.array([64, 220, 50256, 275, 1], "<u4").tobytes()
    for rows in (queries.op8_packing(spark, str(tmp_path)).collect(), corpus_pipeline.packing_stage(spark, docs, str(tmp_path)).collect()):
        assert {r["doc_id"] for r in rows} == set(expected)
        for r in rows:
            n, ids = expected[r["doc_id"]]
            assert r["doc_tokens"] == n
            assert r["ids_crc32"] == zlib.crc32(ids[4 * r["start"] : 4 * (r["start"] + r["length"])])


def test_packing_places_by_sum_of_squares():
    dice = random.Random(6)
    levels, plain = packing.Levels(32), {}
    for _ in range(400):
        size = dice.randint(1, 31)

        def cost(level, size=size):
            after = dict(plain)
            if level:
                after[level] -= 1
            if level + size < 32:
                after[level + size] = after.get(level + size, 0) + 1
            return sum(n * n for n in after.values())

        choices = [h for h in range(0, 33 - size) if h == 0 or plain.get(h)]
        best = min(cost(h) for h in choices)
        got = levels.level(size)
        assert got == max(h for h in choices if cost(h) == best)
        levels.place(size, None)
        if got:
            plain[got] -= 1
        if got + size < 32:
            plain[got + size] = plain.get(got + size, 0) + 1


def test_packing_stays_online():
    """Of what isn't cut off as whole windows, at most a tenth is moved at the end of a task of 1,000 rows."""
    dice = np.random.default_rng(3)
    for sizes in (dice.integers(1, 2048, 1000), np.minimum(20000, dice.lognormal(5.5, 1.2, 1000).astype(int) + 1), dice.integers(60, 200, 1000)):
        tokens = {"whole": 0, "online": 0, "moved": 0}
        pieces = 0
        for window in packing.pack(((i, np.zeros(n, "<u4")) for i, n in enumerate(sizes)), 2048):
            total = sum(end - start for _, _, start, end, _ in window)
            assert total == 2048 or total & (total - 1) == 0
            for _, _, start, end, how in window:
                tokens[how] += end - start
                pieces += how == "online"
        assert sum(tokens.values()) == sizes.sum()
        assert tokens["moved"] < 0.1 * (tokens["online"] + tokens["moved"]), tokens
        assert pieces < 1.6 * len(sizes)


def test_packing_odd_rows(odd):
    rows = packing.pack_documents(odd, MODEL, PATTERN).collect()
    assert len({r["sequence_id"] for r in rows}) >= 1 and sum(r["start"] == 0 for r in rows) == 6


# -- op 10


@pytest.mark.parametrize("name", ["edge", "small", "odd", "empty"])
def test_sharding_rows(request, monkeypatch, name):
    monkeypatch.setattr(sharding, "BLOCK_KEYS", 4)
    df = request.getfixturevalue(name)
    rows = sharding.shard(df).collect()
    expected = sorted((r["doc_id"] is None, r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in df.collect())
    assert sorted((r["doc_id"] is None, r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == expected
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert r["law"] == "key" and 0 <= r["shard"] < 8 and r["grown_shard"] in (r["shard"], 8)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_sharding_by_brute_force(spark):
    """Shards of sparse numbers and of text keys, computed by hand."""
    import math

    def best(key, shards):
        def cost(shard):
            bits = int(hashlib.md5(f"{key}:{shard}".encode()).hexdigest()[:12], 16)
            return -math.log((bits + 0.5) / 2**48)

        return min(range(shards), key=cost)

    dice = random.Random(5)
    numbers = [dice.randint(-(1 << 62), 1 << 62) for _ in range(300)]
    for kind, keys in (("long", numbers), ("string", [f"doc/{n}" for n in numbers])):
        df = spark.createDataFrame([(k, "x") for k in keys] + [(None, "y")], f"doc_id {kind}, text string")
        rows = sharding.shard(df).collect()
        assert len(rows) == 301
        for r in rows:
            key = "null" if r["doc_id"] is None else r["doc_id"]
            assert (r["shard"], r["grown_shard"]) == (best(key, 8), best(key, 9))
        for n in range(8):
            assert sorted(r["slot"] for r in rows if r["shard"] == n) == list(range(sum(r["shard"] == n for r in rows)))


def test_sharding_weights_and_growth(spark):
    keys = spark.range(20000).select("id")
    weights = [1.0, 2.0, 1.0]
    rows = keys.select(sharding.rendezvous(keys["id"], weights).alias("a"), sharding.rendezvous(keys["id"], [1.0, 3.0, 1.0]).alias("b")).collect()
    share = np.bincount([r["a"] for r in rows], minlength=3) / len(rows)
    assert np.allclose(share, [0.25, 0.5, 0.25], atol=0.02)
    assert all(r["a"] == r["b"] or r["b"] == 1 for r in rows)
    with pytest.raises(ValueError):
        sharding.rendezvous(keys["id"], [1.0, 0.0])


def test_confirming_long_near_copies_holds_one_set():
    """Copies of a megabyte each pass by the hub: what is held doesn't grow with their number."""
    import tracemalloc

    import pyarrow as pa
    import zstandard

    dice = random.Random(8)
    words = [f"w{dice.randint(0, 50_000)}" for _ in range(160_000)]

    def batches(count):
        for i in range(count):
            words[i * 7] = f"changed{i}"
            body = zstandard.ZstdCompressor(level=1).compress(" ".join(words).encode())
            yield pa.RecordBatch.from_arrays([pa.array([1]), pa.array([1 + i]), pa.array([body], pa.binary())], ["a", "id", "body"])

    peaks = []
    for count in (3, 24):
        tracemalloc.start()
        found = sum(b.num_rows for b in minhash._confirm(batches(count), 5, 80))
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert found == count - 1
    assert peaks[1] < 1.3 * peaks[0] and peaks[1] < 200 << 20
