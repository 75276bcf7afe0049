"""Operators on vectors against brute force."""

import numpy as np
import pytest

from inquirylake.llm import multiindex, topk
from inquirylake.llm.components import roots


@pytest.fixture(scope="module")
def vectors(spark):
    dice = np.random.default_rng(3)
    rows = []
    for i in range(600):
        base = dice.normal(size=16)
        rows.append((i, base.tolist(), i % 3, "x"))
    for i in range(600, 660):
        rows.append((i, (np.array(rows[i - 600][1]) + dice.normal(size=16) * 0.05).tolist(), i % 3, "x"))
    for i in range(660, 700):
        rows.append((i, rows[1][1], 1, "x"))  # a class of equal vectors
    rows += [(700, None, 1, "x"), (701, [0.0] * 16, 1, "x"), (702, [float("nan")] * 16, 1, "x"), (703, [None] * 16, 1, "x"), (704, [float("inf")] + [1.0] * 15, 1, "x"), (705, rows[1][1], None, "x"), (706, [], 1, "x"), (707, [1.0, 2.0], 1, "x"), (708, [1.0, 2.0], 1, "x"), (None, rows[1][1], 1, "x"), (1, rows[1][1], 1, "x"), (750, [1e200] * 16, 1, "x"), (800, [2e200] * 16, 1, "x")]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, cell string").repartition(3).cache()


def usable(rows, labelled):
    out = []
    for r in rows:
        v = r["embedding"]
        if r["vec_id"] is None or not v or any(x is None or not np.isfinite(x) for x in v) or labelled and (r["label"] is None or not any(v)):
            continue
        out.append(r)
    return out


def test_multi_index_finds_all_links(vectors):
    rows = vectors.collect()
    got = multiindex.near_duplicates(vectors).collect()
    assert len(got) == len(rows)
    fine = usable(rows, True)
    links, edges = {}, []
    for i, a in enumerate(fine):
        links.setdefault(a["vec_id"], set())
        for j, b in enumerate(fine):
            if i == j or a["label"] != b["label"] or len(a["embedding"]) != len(b["embedding"]):
                continue
            x, y = (np.array(r["embedding"]) / np.abs(r["embedding"]).max() for r in (a, b))
            if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.93:
                links[a["vec_id"]].add(j)
                edges.append((a["vec_id"], b["vec_id"]))
    nodes, least = roots(*(np.array(e, np.int64) for e in zip(*edges, strict=True)))
    part = dict(zip(nodes.tolist(), least.tolist(), strict=True))
    for r in got:
        if r["vec_id"] is not None and r["vec_id"] != 1:
            assert r["n_links"] == len(links.get(r["vec_id"], ())), r
            assert r["component_id"] == part.get(r["vec_id"], r["vec_id"])
        assert r["kept"] == (r["vec_id"] is None or r["vec_id"] == r["component_id"])


def test_multi_index_in_small_blocks(vectors, monkeypatch):
    whole = {(r["vec_id"], r["n_links"], r["component_id"]) for r in multiindex.near_duplicates(vectors).collect()}
    monkeypatch.setattr(multiindex, "MEMBERS", 5)
    monkeypatch.setattr(multiindex, "VISITORS", 7)
    assert {(r["vec_id"], r["n_links"], r["component_id"]) for r in multiindex.near_duplicates(vectors).collect()} == whole


def test_multi_index_recall_at_the_threshold():
    dice = np.random.default_rng(5)
    x = multiindex.unit(dice.normal(size=(3000, 32)))
    index = multiindex.Index(x, 60000, 0.93)
    noise = dice.normal(size=x.shape)
    noise -= (noise * x).sum(1)[:, None] * x
    other = 0.93 * x + np.sqrt(1 - 0.93**2) * multiindex.unit(noise)
    own = list(zip(*(near.tolist() for near, _ in index.look(other)), strict=True))
    visited = list(index.cells(x))
    assert np.mean([o in v for o, v in zip(own, visited, strict=True)]) > 0.99
    assert np.mean([len(v) for v in visited]) < 0.5 * len(index.halves[0].words) ** 2


def test_top_k_is_exact(vectors):
    rows = vectors.where("vec_id is null or vec_id < 750").collect()
    got = topk.top_k(vectors.where("vec_id is null or vec_id < 750"), 50, 5).collect()
    fine = usable(rows, False)
    terms = {id(r): [int(np.floor(256 * x)) for x in r["embedding"]] for r in fine}
    expected = {}
    for q in fine:
        if q["vec_id"] % 50 == 0:
            scores = [(-sum(a * b for a, b in zip(terms[id(q)], terms[id(r)], strict=True)), r["vec_id"]) for r in fine if r["vec_id"] != q["vec_id"] and len(r["embedding"]) == len(q["embedding"])]
            expected |= {(q["vec_id"], n + 1): (i, -s) for n, (s, i) in enumerate(sorted(scores)[:5])}
    assert {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in got} == expected


def test_max_score_prunes_and_stays_exact():
    dice = np.random.default_rng(7)
    postings = np.floor(dice.normal(size=(64, 500)) * 30)
    ids = dice.permutation(500)
    for _ in range(50):
        query = np.floor(dice.normal(size=64) * 30)
        best = []
        for part in np.array_split(np.arange(500), 4):
            best = topk.search(query, 3, ids[part], postings[:, part], best, 5)
        assert best == sorted((-int(s), int(i)) for s, i in zip(query @ postings, ids, strict=True) if i != 3)[:5]


def test_essential_terms_follow_the_threshold(monkeypatch):
    """The higher the k-th score already stands, the fewer postings are traversed."""
    dice = np.random.default_rng(8)
    postings, queries = np.floor(dice.normal(size=(64, 4000)) * 30), np.floor(dice.normal(size=(20, 64)) * 30)
    exact = np.sort(queries @ postings, axis=1)[:, ::-1]
    widths = []
    for rank in (4000, 2000, 5):
        best = topk.Best(20, 5)
        best.scores[:] = exact[:, rank - 1][:, None]
        best.ids[:] = 10**9
        traversed = []
        monkeypatch.setattr(topk.np, "unique", lambda x, f=np.unique, t=traversed: (t.append(x.mean()), f(x))[1])
        topk.search_block(queries, np.full(20, -1), np.arange(4000), postings, best)
        monkeypatch.undo()
        widths.append(traversed[0])
        assert (best.scores[:, 0] == exact[:, 0]).all()
    assert widths[0] > widths[1] > widths[2]


def test_top_k_beyond_exact_doubles(spark):
    rows = [(0, [1.0, 0.0]), (1, [-1e300, 1.0]), (2, [1e9 + 0.123, 3.0]), (3, [1e9 + 0.127, 3.0]), (50, [1e9, 1.0]), (100, [1.7e308, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = {i: [int(x) * 256 if abs(x) > 2**60 else int(np.floor(x * 256)) for x in v] for i, v in rows}
    expected = {}
    for q in (0, 50, 100):
        found = sorted((max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(whole[q], whole[i], strict=True)))) * -1, i) for i in whole if i != q)
        expected |= {(q, n + 1): (i, -s) for n, (s, i) in enumerate(found[:5])}
    assert {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in topk.top_k(df).collect()} == expected


def test_empty_tables(spark, vectors):
    none = vectors.limit(0)
    assert multiindex.near_duplicates(none).count() == 0
    assert topk.top_k(none).count() == 0
    assert topk.top_k(vectors.where("vec_id = 50")).count() == 0


def test_multiindex_counts_found_pairs_for_both_ends(spark, monkeypatch):
    """With a short reach one of two neighbours often visits the other's cell, but not the reverse."""
    made, links = [], multiindex._links
    monkeypatch.setattr(multiindex.Index, "_reach", lambda *_: 0.02)
    monkeypatch.setattr(multiindex, "_links", lambda c, index, *more: (made.append(index), links(c, index, *more))[1])
    noise = np.random.default_rng(4)
    x = np.repeat(noise.normal(size=(20, 8)), 15, 0) + 0.2 * noise.normal(size=(300, 8))
    rows = [(i, v.tolist(), "a") for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    got = {r["vec_id"]: r["n_links"] for r in multiindex.near_duplicates(df).collect()}
    x = multiindex.unit(x)
    cells = list(made[0].cells(x))
    visits = np.array([[b[0] in a for b in cells] for a in cells])
    near = (x @ x.T >= 0.93) & ~np.eye(len(x), dtype=bool)
    assert (near & visits & ~visits.T).any()
    assert got == dict(enumerate((near & (visits | visits.T)).sum(1).tolist()))


def test_recall_at_the_threshold(spark):
    """Planted pairs just above the threshold among eight thousand vectors of several labels, from end to end."""
    dice = np.random.default_rng(12)
    base = dice.normal(size=(6000, 32))
    base /= np.linalg.norm(base, axis=1)[:, None]
    noise = dice.normal(size=(2000, 32))
    noise -= (noise * base[:2000]).sum(1)[:, None] * base[:2000]
    noise /= np.linalg.norm(noise, axis=1)[:, None]
    cosine = dice.uniform(0.932, 0.97, size=(2000, 1))
    every = np.concatenate([base, cosine * base[:2000] + np.sqrt(1 - cosine**2) * noise, base[:100]])
    labels = np.concatenate([np.arange(6000) % 3, np.arange(2000) % 3, np.arange(100) % 3])
    rows = [(i, v.tolist(), int(label)) for i, (v, label) in enumerate(zip(every, labels, strict=True))]
    got = {r["vec_id"]: r["n_links"] for r in multiindex.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    units = every / np.linalg.norm(every, axis=1)[:, None]
    near = (units @ units.T >= 0.93) & (labels[:, None] == labels[None]) & ~np.eye(len(units), dtype=bool)
    wanted = near.sum(1)
    found = np.array([got[i] for i in range(len(every))])
    assert (found <= wanted).all() and wanted.sum() >= 4000
    print("links found at cosine 0.93 to 0.97:", found.sum() / wanted.sum())
    assert found.sum() / wanted.sum() >= 0.99


def test_hundreds_of_lengths(spark):
    """Vectors of hundreds of lengths: all but the most common one are compared in one job."""
    dice = np.random.default_rng(5)
    rows = []
    for dims in range(1, 401):
        v = dice.normal(size=dims)
        rows += [(3 * dims, v.tolist(), 1), (3 * dims + 1, (v * 2 + (0.01 if dims > 1 else 0)).tolist(), 1), (3 * dims + 2, v.tolist(), 2)]
    rows += [(5000 + i, dice.normal(size=16).tolist(), 1) for i in range(50)]
    got = {r["vec_id"]: r for r in multiindex.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    vectors = {i: (np.array(v) / np.linalg.norm(v), label) for i, v, label in rows}
    for i, (v, label) in vectors.items():
        links = [j for j, (w, other) in vectors.items() if j != i and other == label and len(w) == len(v) and v @ w >= 0.93]
        assert got[i]["n_links"] == len(links), i
        assert got[i]["component_id"] <= min([i, *links])
