"""Op 12 against brute force: runs, collapsed texts and digests."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from inquirylake.llm import periods, queries
from tests.llm.conftest import texts_of

SPLIT = re.compile("[^\x20\x09-\x0d]+")


def brute(words, least):
    """Stretches of equal words q apart, for each q; the smallest q of a stretch counts."""
    n, out = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i - start + q >= max(least, 2 * q):
                out.setdefault((start, i - start + q), q)
            i += i == start
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def sequences(count, seed):
    dice = random.Random(seed)
    for _ in range(count):
        n, letters = dice.randint(0, 60), dice.choice([1, 2, 2, 3, 5])
        out = [dice.randint(1, letters) for _ in range(n)]
        if n > 3 and dice.random() < 0.5:
            at, period = dice.randint(0, n - 1), dice.randint(1, n // 2)
            out = [out[i] if i < at else out[at + (i - at) % period] for i in range(n)]
        yield out


@pytest.mark.parametrize("least", [2, 12])
def test_runs_of_random_words(least):
    for words in sequences(1500, least):
        assert [tuple(r) for r in periods.find_runs(np.array(words, np.int64), least).tolist()] == brute(words, least), words


def test_fingerprints_that_lie(monkeypatch):
    monkeypatch.setattr(periods.Words, "alike", lambda self, i, j, length: np.ones(len(i), bool))
    monkeypatch.setattr(periods.Words, "scalars", lambda self: [(1, [0] * (self.n + 1), [0] * (self.n + 1))])
    for words in [*sequences(300, 5), [1, 2, 3] * 30 + [4] + [1, 2, 3] * 30]:
        assert [tuple(r) for r in periods.find_runs(np.array(words, np.int64), 12).tolist()] == brute(words, 12)


def test_words_of_special_structure():
    """Fibonacci and Thue-Morse words, powers of one and two words: many runs, or long ones."""
    fibonacci, longer, thue = [1], [1, 2], [1]
    while len(longer) < 600:
        fibonacci, longer = longer, longer + fibonacci
    while len(thue) < 512:
        thue += [3 - x for x in thue]
    for words in (longer, thue, [1] * 500, [1, 2] * 250, [*range(1, 100)] * 4):
        assert [tuple(r) for r in periods.find_runs(np.array(words, np.int64), 12).tolist()] == brute(words, 12)
    assert periods.find_runs(np.array([1] * 100_000), 12).tolist() == [[0, 100_000, 1]]


@pytest.mark.parametrize("name", ["edge", "odd", "empty", "small"])
def test_rows(request, name):
    df = request.getfixturevalue(name)
    got = sorted((r["doc_id"] is None, r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periods.detect(df).collect())
    expected = []
    for r in df.select("doc_id", "text").collect():
        words = SPLIT.findall(r["text"] or "")
        runs = brute(words, 12) if len(words) < 2000 else None
        expected.append((r["doc_id"] is None, r["doc_id"], len(words), runs, None if runs is None else collapsed(words, runs)))
    assert [g[:3] for g in got] == [e[:3] for e in sorted(expected, key=repr_key)]
    for mine, theirs in zip(got, sorted(expected, key=repr_key), strict=True):
        assert theirs[3] is None or mine[3:] == theirs[3:]


def repr_key(row):
    return (row[0], row[1] or 0, row[2], row[3] or [], row[4] or "")


def test_planted_rule(spark, odd, empty):
    texts = {i: " ".join(f"w{i * 7 % 13 + k}" for k in range(i % 90)) for i in range(300)}
    df = spark.createDataFrame([*texts.items(), (None, "no id")], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in periods.planted(df).collect()}
    assert got.pop(None) == "no id"
    moved = 0
    for i, text in texts.items():
        words, h = SPLIT.findall(text), zlib.crc32(str(i).encode())
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (k - a) % p] for k in range(a, n)]
            moved += " ".join(words) != text
        assert got[i].split() == words
    assert moved > 5
    assert periods.planted(odd).count() == odd.count() and periods.planted(empty).count() == 0


def test_digests(spark, edge):
    df = edge.where("doc_id <> 18")
    for r in periods.digests(periods.detect(df)).collect():
        words = SPLIT.findall(dict(texts_of(edge))[r["doc_id"]])
        runs = brute(words, 12)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert (r["n_runs"], r["runs_sha256"], r["collapsed_sha256"]) == (len(runs), hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed(words, runs).encode()).hexdigest())
        best = min(((-n, s, q) for s, n, q in runs), default=None)
        assert (r["start"], r["length"], r["period"], r["exponent_milli"]) == ((best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4)
    assert "op12_runs" in queries.SQL


def test_long_periodic_text(spark):
    """Hundreds of thousands of words, in one document, with a few runs."""
    text = "a b " * 100_000 + "x " + "c " * 50_000 + " ".join(f"w{i}" for i in range(1000)) + " " + " ".join(f"w{i}" for i in range(1000))
    row = periods.detect(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [tuple(r) for r in row["runs"]] == [(0, 200_000, 2), (200_001, 50_000, 1), (250_001, 2000, 1000)]
    assert len(row["collapsed"].split()) == 2 + 1 + 1 + 1000
