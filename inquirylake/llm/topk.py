"""Op 6: exact top-k inner products with MaxScore over shards of posting lists."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Rows of a query block, of a shard of postings that is bounded and searched at once, and of a salt.
QUERIES, SHARD, SALT = 1024, 8192, 1 << 19
#: Terms that are taken at once; survivors' share above which their postings are traversed whole.
STEP, DENSE = 8, 1 / 16
PACKED = "dims int, peak double, ids binary, weights binary"


def quantize(vectors: DataFrame) -> DataFrame:
    """vec_id and finite components as array<double>; unusable vectors are left out."""
    x = F.col("embedding").cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0) & ~F.coalesce(bad, F.lit(True)))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("terms"))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each number of dimensions and slice of a batch: ids and term-major weights.

    Weights are floor(256 x), as 16-bit integers if all are small enough, else x itself.
    """
    for batch in batches:
        sizes = np.asarray(batch["terms"].value_lengths())
        for dims in np.unique(sizes):
            part = batch.take(pa.array(np.flatnonzero(sizes == dims)))
            ids = part["vec_id"].to_numpy().astype("<i8")
            x = np.asarray(part["terms"].flatten()).astype("<f8").reshape(-1, dims)
            for i in range(0, len(ids), QUERIES):
                own = x[i : i + QUERIES]
                with np.errstate(over="ignore"):
                    terms = np.floor(own * 256)
                peak = float(np.abs(terms).max())
                weights = terms.astype("<i2") if peak < 1 << 15 else own
                yield pa.RecordBatch.from_arrays([pa.array([int(dims)], pa.int32()), pa.array([peak]), pa.array([ids[i : i + QUERIES].tobytes()]), pa.array([weights.T.tobytes()])], ["dims", "peak", "ids", "weights"])


def _postings(row: dict) -> tuple[np.ndarray, np.ndarray, float]:
    """ids, term-major weights (16-bit integers, or components that are not yet scaled), peak."""
    small = row["peak"] < 1 << 15
    return np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["weights"], "<i2" if small else "<f8").reshape(row["dims"], -1), row["peak"]


def _whole(weights: np.ndarray) -> np.ndarray:
    """floor(256 x) as Python integers, for weights that leave exact double arithmetic."""
    if weights.dtype != np.float64:
        return weights.astype(object)
    return np.array([[int(x) * 256 if abs(x) > 2.0**53 else int(np.floor(x * 256)) for x in row] for row in weights.tolist()], object).reshape(weights.shape)


def _doubles(weights: np.ndarray) -> np.ndarray:
    return np.floor(weights * 256) if weights.dtype == np.float64 else weights.astype(np.float64)


class Best:
    """The k best scores and ids of each query of a block, best first, ties by the smaller id."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.scores, self.ids = np.full((queries, k), -np.inf), np.zeros((queries, k), np.int64)

    def floors(self) -> np.ndarray:
        """What a row must reach to count: each query's k-th score so far."""
        return self.scores[:, -1] if self.k else np.full(len(self.scores), np.inf)

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        old = np.isfinite(self.scores)
        q = np.concatenate([np.nonzero(old)[0], query])
        s = np.concatenate([self.scores[old], score])
        i = np.concatenate([self.ids[old], ids])
        order = np.lexsort((i, -s, q))
        q, s, i = q[order], s[order], i[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        kept = rank < self.k
        self.scores[:] = -np.inf
        self.scores[q[kept], rank[kept]], self.ids[q[kept], rank[kept]] = s[kept], i[kept]


def search_block(queries: np.ndarray, own: np.ndarray, ids: np.ndarray, postings: np.ndarray, best: Best) -> None:
    """Adds one shard's rows to what is best for each query, by MaxScore.

    A term's contribution lies between bounds that its weights in the shard give; terms are taken
    by the width of their bounds.  A query's terms are essential up to where a row that has no more
    than the least of them could still reach the k-th score with all of the others; so the split
    follows the threshold, which rises from shard to shard.  Essential postings are traversed for
    all rows, as a product over the queries that have equally many; the other terms are probed for
    those rows that still compete, a few terms at a time.
    """
    terms, n = postings.shape
    low, high = postings.min(1), postings.max(1)
    least, most = np.minimum(queries * low, queries * high), np.maximum(queries * low, queries * high)
    order = np.argsort(-(most - least).sum(0), kind="stable")
    queries, postings, least, most = queries[:, order], postings[order], least[:, order], most[:, order]
    nothing = np.zeros((len(queries), 1))
    upper = np.hstack([np.cumsum(most[:, ::-1], axis=1)[:, ::-1], nothing])  # what the terms from here on can add
    lower = np.hstack([nothing, np.cumsum(least, axis=1)])  # what the terms up to here add at least
    floors = best.floors()
    open_ = lower + upper >= floors[:, None]  # falls with the number of essential terms
    essential = np.minimum(terms, -(-open_.sum(1) // STEP) * STEP)
    for at in np.unique(essential).tolist():
        group = np.flatnonzero(essential == at)
        if not at:  # no row of the shard can compete
            continue
        own_queries, floor = queries[group], floors[group]
        partial = own_queries[:, :at] @ postings[:at]
        partial[own[group][:, None] == ids[None]] = -np.inf
        while True:
            if at == terms and n > best.k:
                floor = np.maximum(floor, np.partition(partial, n - best.k, axis=1)[:, n - best.k])
            alive = (partial + upper[group, at][:, None] >= floor[:, None]) & (partial > -np.inf)
            found = int(alive.sum())
            if at == terms or found < DENSE * alive.size:
                break
            step = slice(at, min(terms, at + STEP))
            partial += own_queries[:, step] @ postings[step]
            at = step.stop
        q, rows = np.nonzero(alive)
        score = partial[q, rows]
        while at < terms and len(q):
            step = slice(at, min(terms, at + STEP))
            score = score + np.einsum("ij,ji->i", own_queries[q, step], postings[step, rows])
            at = step.stop
            kept = score + upper[group[q], at] >= floor[q]
            q, rows, score = q[kept], rows[kept], score[kept]
        best.add(group[q], score, ids[rows])


def search(query: np.ndarray, own: int, ids: np.ndarray, postings: np.ndarray, best: list[tuple[int, int]], k: int) -> list[tuple[int, int]]:
    """The k best (-score, id) of what was best before and this shard's rows, for a single query."""
    state = Best(1, k)
    state.add(np.zeros(len(best), np.int64), np.array([-s for s, _ in best], np.float64), np.array([i for _, i in best], np.int64))
    search_block(np.asarray(query, np.float64)[None], np.array([own]), np.asarray(ids), np.asarray(postings, np.float64), state)
    return [(-int(s), int(i)) for s, i in zip(state.scores[0], state.ids[0], strict=True) if np.isfinite(s)]


def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Packed rows ordered by salt, dims and kind: a salt's postings, then each query block once."""
    at, shards, held = None, [], []
    for batch in batches:
        for row in batch.to_pylist():
            if (row["salt"], row["dims"]) != at:
                at, shards, held = (row["salt"], row["dims"]), [], []
            if not row["asked"]:
                held.append(_postings(row))
                continue
            if held:
                shards, held = list(_shards(held)), []
            if shards:
                yield _answer(*_postings(row), shards, k)


def _shards(held: list[tuple[np.ndarray, np.ndarray, float]]) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """Packed postings of like precision put together, so that a shard has about SHARD rows."""
    for small in (True, False):
        some = [x for x in held if (x[1].dtype != np.float64) == small]
        each = max(1, SHARD // QUERIES)
        for i in range(0, len(some), each):
            part = some[i : i + each]
            yield np.concatenate([x[0] for x in part]), np.concatenate([x[1] for x in part], axis=1), max(x[2] for x in part)


def _answer(own: np.ndarray, weights: np.ndarray, peak: float, shards: list, k: int) -> pa.RecordBatch:
    dims = len(weights)
    exact = [dims * (peak + 1) * (x[2] + 1) < 2.0**53 for x in shards]
    state = Best(len(own), k)
    if any(exact):
        queries = np.ascontiguousarray(_doubles(weights).T)
        for (ids, postings, _), fine in zip(shards, exact, strict=True):
            if fine:
                search_block(queries, own, ids, _doubles(postings), state)
    fine = np.isfinite(state.scores)
    rows = [(int(own[q]), int(i), int(s)) for q, i, s in zip(np.nonzero(fine)[0], state.ids[fine], state.scores[fine], strict=True)]
    if not all(exact):
        queries = _whole(weights).T
        for (ids, postings, _), fine in zip(shards, exact, strict=True):
            if not fine:
                whole = _whole(postings)
                for n, query in enumerate(queries):
                    scores = query @ whole
                    best = sorted(((-s, i) for s, i in zip(scores.tolist(), ids.tolist(), strict=True) if i != own[n]))[:k]
                    rows += [(int(own[n]), i, max(-(1 << 63), min((1 << 63) - 1, -s))) for s, i in best]
    columns = list(zip(*rows, strict=True)) or [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])


def top_k(vectors: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k best inner products, exactly.

    Queries are the rows whose vec_id is divisible by ``every``; candidates are all rows of as many
    components but those with the query's own vec_id.  Ties go to the smaller vec_id.  Left out are
    rows with a null vec_id, and null or empty vectors and those with null or non-finite
    components.  Scores that leave exact doubles are computed in whole numbers; one beyond 64 bits
    is given (and ranked) as the nearest 64-bit number.  Repeated vec_ids: one query, of the least
    vector, and each row a candidate.  With fewer candidates than k all are returned; an empty table
    gives no rows; other columns are ignored.

    Postings are dealt once, by salt, and stay there; each salt reads the packed query blocks once
    and gives out k rows a query at most.  The number of salts bounds the postings that a task holds.
    """
    spark = vectors.sparkSession
    rows = quantize(vectors)
    asked = common.checkpoint(rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("terms").alias("terms")))
    n = max(1, -(-asked.count() // QUERIES))
    salts = max(common.partitions(spark), -(-vectors.count() // SALT))
    kept = ["salt", "dims", "asked", "peak", "ids", "weights"]
    # packed rows are dealt in turn, so that each salt gets about as many
    number = F.monotonically_increasing_id()
    turn = F.pmod(F.shiftright(number, 33) + number.bitwiseAND(F.lit((1 << 33) - 1)), F.lit(salts))
    shards = common.arrow_map(rows, _pack, PACKED).withColumns({"salt": turn.cast("int"), "asked": F.lit(False)})
    blocks = common.arrow_map(asked.repartition(n), _pack, PACKED).withColumns({"salt": F.explode(F.sequence(F.lit(0), F.lit(salts - 1))), "asked": F.lit(True)})
    dealt = shards.select(kept).unionByName(blocks.select(kept)).repartitionById(salts, F.col("salt")).sortWithinPartitions("salt", "dims", "asked")
    found = common.arrow_map(dealt, _search, "query_id long, vec_id long, score long", k)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
