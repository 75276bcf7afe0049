"""Op 13 against plain Lloyd's, with brute-force assignments."""

import hashlib
import random

import numpy as np
import pytest

from inquirylake.llm import lloyd

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error long, cells int, entry int, _label string, label_error int"


def brute(rows, parts=8, entries=16, rounds=6):
    """vec_id, code, error of each row, and the books, by comparing every part with every entry."""
    whole = [(i, [int(np.floor(4096 * float(np.float32(x)))) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    first = {}
    for i, v, _ in sorted((r[:3] for r in whole if r[0] is not None), key=lambda r: (r[0], r[1])):
        first.setdefault(i, v)
    starts = [v for _, v in sorted(first.items())][:entries]
    if not starts:
        return [], []
    width = len(starts[0])
    kept = [r for r in whole if len(r[1]) == width]
    bounds = [width * k // parts for k in range(parts + 1)]
    books = [[v[a:b] for v in starts if len(v) == width] for a, b in zip(bounds, bounds[1:], strict=False)]

    def nearest(part, book):
        return min((sum((x - y) ** 2 for x, y in zip(part, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
            groups = {}
            for _, v, _ in kept:
                groups.setdefault(nearest(v[a:b], books[p])[1], []).append(v[a:b])
            books[p] = [[sum(c) // len(groups[k]) for c in zip(*groups[k], strict=True)] if k in groups else e for k, e in enumerate(books[p])]
    out = []
    for i, v, label in kept:
        best = [nearest(v[a:b], books[p]) for p, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False))]
        out.append((i, "".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best), label))
    return out, books


def held(spark, rows, schema="vec_id long, embedding array<float>, label int", **options):
    coded, books = lloyd.encode(spark.createDataFrame(rows, schema).repartition(3), **options)
    got = lloyd.with_label_error(coded).collect()
    expected, their_books = brute(rows, **options)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    assert sorted(((r["vec_id"], r["code"], r["error"], None if r["label"] is None else int(r["label"])) for r in got), key=key) == sorted(expected, key=key)
    assert [b.tolist() for b in books] == their_books
    sums = {}
    for _, _, error, label in expected:
        sums[label] = sums.get(label, 0) + error
    assert all(r["label_error"] == sums[None if r["label"] is None else int(r["label"])] for r in got)
    return books


def vectors(count, width, seed, spread=1.0):
    dice = np.random.default_rng(seed)
    centres = dice.normal(size=(12, width))
    return [(i, (centres[i % 12] * spread + dice.normal(size=width) * 0.1).astype("float32").tolist(), i % 5 if i % 7 else None) for i in range(count)]


def test_clustered_vectors(spark):
    """Some two thousand vectors, near centres: whole subtrees have one entry, others are cut to leaves."""
    books = held(spark, vectors(2000, 16, 1))
    text = ",".join(str(x) for b in books for x in b.ravel().tolist())
    assert lloyd.codebooks_digest(books) == hashlib.sha256(text.encode()).hexdigest()


def test_odd_vectors(spark):
    """Nulls, non-finite components, repeated and missing ids, equal vectors, another length."""
    dice = random.Random(2)
    rows = vectors(60, 8, 3)
    rows += [(None, rows[5][1], 1), (3, rows[7][1], 2), (3, rows[3][1], 2), (100, None, 1), (101, [0.5] * 7 + [None], 1), (102, [float("nan")] + [0.1] * 7, 1), (103, [float("inf")] * 8, None), (104, [0.25] * 9, 1), (105, [], 1)]
    rows += [(200 + i, [0.125] * 8, None) for i in range(40)]
    rows += [(300 + i, [dice.choice([-0.0001, 0.0, 0.0001]) for _ in range(8)], 3) for i in range(80)]
    held(spark, rows)
    named = spark.createDataFrame([(*r, "c", 1, 2, 3, "l", 4) for r in rows], SCHEMA)
    assert lloyd.encode(named)[0].count() == len(brute(rows)[0])


def test_few_rows_and_none(spark):
    held(spark, [(5, [0.5, -0.25, 0.125, 1.0, 0.0, 0.0, 2.0, -2.0], None), (6, [0.5] * 8, 1)])
    held(spark, [(1, [0.5, 0.25, 0.75], 1), (2, [0.5, 0.125, -0.75], 1)], parts=2, entries=2)
    held(spark, [(1, [0.5, 0.25], 1), (2, [0.5, 0.125], 1)])  # fewer components than parts
    for rows in ([], [(1, None, 1)], [(None, [0.5] * 8, 1)]):
        coded, books = lloyd.encode(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
        assert coded.count() == 0 and books == [] and lloyd.with_label_error(coded).count() == 0


def test_one_label_and_one_id_hold_most_rows(spark):
    rows = [(i if i > 900 else 1, v, 1 if i > 100 else 2) for i, v, _ in vectors(1500, 8, 9)]
    held(spark, rows, entries=8, rounds=3)


def test_components_beyond_exact_arithmetic(spark):
    df = spark.createDataFrame([(1, [1e9] * 8, 1)], "vec_id long, embedding array<float>, label int")
    with pytest.raises(Exception, match="64 bits"):
        lloyd.encode(df)[0].collect()


def test_filtering_skips_most_comparisons():
    """Near centres, whole subtrees are assigned: fewer points than a tenth are met one by one."""
    points = np.array([[int(4096 * x) for x in v[:8]] for _, v, _ in vectors(4000, 8, 4, spread=8.0)])
    order, here, levels = lloyd.tree(points)
    book = here[[np.flatnonzero(order == k)[0] for k in range(12)]]
    met, out = 0, np.full(len(points), -1)
    for d, at, entry in lloyd.assigned(here, levels, book):
        if d < 0:
            met, out[at] = len(at), entry
        else:
            for a, e in zip(at.tolist(), entry.tolist(), strict=True):
                out[len(points) * a >> d : len(points) * (a + 1) >> d] = e
    assert (out == ((here[:, None] - book) ** 2).sum(2).argmin(1)).all()
    assert met < len(points) / 10
