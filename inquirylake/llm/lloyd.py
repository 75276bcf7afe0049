"""Op 13: codes of vectors by product quantisation, its codebooks learnt by filtering over kd-trees."""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Points of a leaf, which are compared one by one, and bytes of a block's points.
LEAF, BLOCK = 16, 2 << 20
BLOCKS = "ids array<long>, labels array<string>, trees binary"


def kept(table: DataFrame, scale: int = 4096) -> DataFrame:
    """vec_id, label (as text) and cells, floor(scale * x) of each component, of the vectors that are whole."""
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    cells = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return table.where(F.col("embedding").isNotNull() & whole).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), cells.alias("cells"))


def first_rows(rows: DataFrame, entries: int) -> list[list[int]]:
    """The cells of the smallest ids, ascending; of rows that share an id, the least cells.

    Each pass asks for a few rows after the last id, so ids that many rows share cost passes, at most
    one for each entry, and no shuffle.
    """
    found: dict[int, list[int]] = {}
    while True:
        after = rows.where(F.col("vec_id") > max(found)) if found else rows.where("vec_id is not null")
        batch = after.orderBy("vec_id", "cells").limit(entries).collect()
        for row in batch:
            found.setdefault(row["vec_id"], row["cells"])
        if len(batch) < entries or len(found) >= entries:
            return list(found.values())[:entries]


def cuts(width: int, parts: int) -> list[int]:
    """Where each part ends; parts are equal, or as equal as the width allows."""
    return [width * (k + 1) // parts for k in range(parts)]


def tree(points: np.ndarray) -> tuple:
    """A balanced kd-tree: the points' order, the points so, and for each level its boxes and sums.

    Node k of level d holds the points from n * k >> d to n * (k + 1) >> d; each level is cut at the
    middle of its boxes' widest side.
    """
    n, depth = len(points), 0
    while n >> depth > LEAF:
        depth += 1
    order = np.arange(n)
    for d in range(depth):
        bounds = n * np.arange((1 << d) + 1) >> d
        here = points[order]
        wide = np.maximum.reduceat(here, bounds[:-1]) - np.minimum.reduceat(here, bounds[:-1])
        node = np.repeat(np.arange(1 << d), np.diff(bounds))
        side = wide.argmax(1)[node] if wide.shape[1] else node * 0
        order = order[np.lexsort((here[np.arange(n), side], node))] if wide.shape[1] else order
    here, levels = points[order], []
    for d in range(depth + 1):
        starts = n * np.arange(1 << d) >> d
        levels.append(tuple(f.reduceat(here, starts) for f in (np.minimum, np.maximum, np.add)))
    return order, here, levels


def assigned(points: np.ndarray, levels: list[tuple], book: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Level, nodes and entries of whole subtrees with one nearest entry; then level -1, positions, entries.

    At a node the entry nearest to the box's middle is held against the others: one that is no nearer
    at the box's corner that favours it most is nearest to no point below (a tie goes to the lower
    index).  All nodes of a level are filtered at once.
    """
    n, entries = len(points), np.arange(len(book))
    nodes, alive = np.zeros(1, int), np.ones((1, len(book)), bool)
    for d, (low, high, _) in enumerate(levels):
        lo, hi = low[nodes][:, None], high[nodes][:, None]
        middle = ((lo + hi - 2 * book) ** 2).sum(2)
        best = np.where(alive, middle, np.iinfo(np.int64).max).argmin(1)
        near = book[best][:, None]
        corner = np.where(book > near, hi, lo)
        loses = ((corner - book) ** 2 - (corner - near) ** 2).sum(2)
        alive &= ~((loses > 0) | ((loses == 0) & (entries > best[:, None])))
        one = alive.sum(1) == 1
        yield d, nodes[one], best[one]
        nodes, alive = nodes[~one], alive[~one]
        if d < len(levels) - 1:
            nodes, alive = np.repeat(nodes * 2, 2) + np.tile([0, 1], len(nodes)), np.repeat(alive, 2, 0)
    deepest = len(levels) - 1
    starts, ends = n * nodes >> deepest, n * (nodes + 1) >> deepest
    sizes = ends - starts
    places = np.repeat(starts - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum()) if len(nodes) else np.zeros(0, int)
    far = ((points[places][:, None] - book) ** 2).sum(2)
    yield -1, places, np.where(np.repeat(alive, sizes, 0), far, np.iinfo(np.int64).max).argmin(1) if len(places) else places


def _blocks(batches: Iterator[pa.RecordBatch], width: int, ends: list[int]) -> Iterator[pa.RecordBatch]:
    most, held = max(LEAF, BLOCK // (8 * max(1, width))), []

    def out(rows: pa.Table) -> pa.RecordBatch:
        points = np.asarray(rows["cells"].combine_chunks().flatten(), np.int64).reshape(len(rows), width)
        limit = int((2**60 / max(1, width)) ** 0.5)
        if points.size and max(points.max(), -points.min()) > limit:
            raise ValueError(f"components beyond {limit} after scaling: squared distances don't fit into 64 bits")
        trees = [tree(points[:, a:b]) for a, b in zip([0, *ends], ends, strict=False)]
        return pa.RecordBatch.from_arrays([pa.array([rows["vec_id"].to_pylist()], pa.list_(pa.int64())), pa.array([rows["label"].to_pylist()], pa.list_(pa.string())), pa.array([pickle.dumps(trees)], pa.binary())], ["ids", "labels", "trees"])

    for batch in batches:
        held.append(batch)
        rows = pa.Table.from_batches(held)
        while len(rows) >= most:
            yield out(rows.slice(0, most))
            rows = rows.slice(most)
        held = rows.to_batches()
    if held and len(rows := pa.Table.from_batches(held)):
        yield out(rows)


def _sums(batches: Iterator[pa.RecordBatch], books: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    totals, counts = [np.zeros_like(b) for b in books], [np.zeros(len(b), np.int64) for b in books]
    for batch in batches:
        for body in batch["trees"].to_pylist():
            for part, (_, points, levels) in enumerate(pickle.loads(body)):
                for d, at, entry in assigned(points, levels, books[part]):
                    n = len(points)
                    np.add.at(totals[part], entry, points[at] if d < 0 else levels[d][2][at])
                    np.add.at(counts[part], entry, 1 if d < 0 else (n * (at + 1) >> d) - (n * at >> d))
    for part, (total, count) in enumerate(zip(totals, counts, strict=True)):
        used = np.flatnonzero(count)
        if len(used):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(used), part, np.int32)), pa.array(used.astype(np.int32)), pa.array(total[used].tolist(), pa.list_(pa.int64())), pa.array(count[used])], ["part", "entry", "total", "n"])


def _codes(batches: Iterator[pa.RecordBatch], books: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for ids, labels, body in zip(batch["ids"].to_pylist(), batch["labels"].to_pylist(), batch["trees"].to_pylist(), strict=True):
            codes, error = np.zeros((len(ids), len(books)), np.int64), np.zeros(len(ids), np.int64)
            for part, (order, points, levels) in enumerate(pickle.loads(body)):
                n, entry_of = len(points), np.zeros(len(ids), np.int64)
                for d, at, entry in assigned(points, levels, books[part]):
                    if d < 0:
                        entry_of[at] = entry
                    else:
                        for a, b, e in zip((n * at >> d).tolist(), (n * (at + 1) >> d).tolist(), entry.tolist(), strict=True):
                            entry_of[a:b] = e
                codes[order, part] = entry_of
                error[order] += ((points - books[part][entry_of]) ** 2).sum(1)
            text = ["".join(map("{:02x}".format, row)) for row in codes.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(labels, pa.string()), pa.array(text), pa.array(error)], ["vec_id", "label", "code", "error"])


def encode(table: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> tuple[DataFrame, list[np.ndarray]]:
    """vec_id, label (as text), code and error of each vector of vec_id, embedding, label; and the codebooks.

    Components become floor(scale * x), vectors are cut into equal parts (as equal as can be, where the
    length isn't divisible), each with a codebook of its own.  It starts as the parts of the vectors
    with the smallest ids; each round moves an entry to the floored mean of the parts nearest to it
    (ties: lower index), and one that has none stays.  error is the sum of squared distances.

    Vectors that are null or hold null or non-finite components are dropped, and so are those of
    another length than the vector of the smallest id.  A null vec_id starts no entry, but is coded;
    of rows that share an id, the least vector starts the entry and each is coded.  Fewer rows than
    entries: a smaller codebook.  Without a row that has an id: no rows.  Components so large that
    squared distances leave 64 bits raise a ValueError.  Other columns are ignored.

    Each partition cuts its vectors to blocks and writes each block's kd-trees once, with boxes and
    sums; a round reads the trees alone.  What comes back to the driver are sums by entry, as large
    as the codebooks.
    """
    spark = table.sparkSession
    rows = kept(table, scale)
    if entries > 256:
        raise ValueError("a code has two hexadecimal digits for each part")
    first = first_rows(rows, entries)
    if not first:
        return spark.createDataFrame([], "vec_id long, label string, code string, error long"), []
    width = len(first[0])
    ends = cuts(width, parts)
    start = np.array([f for f in first if len(f) == width], np.int64).reshape(-1, width)
    books = [start[:, a:b].copy() for a, b in zip([0, *ends], ends, strict=False)]
    blocks = common.checkpoint(common.arrow_map(rows.where(F.size("cells") == width), _blocks, BLOCKS, width, ends))
    for _ in range(rounds):
        sums = common.arrow_map(blocks.select("trees"), _sums, "part int, entry int, total array<long>, n long", books)
        each = sums.select("part", "entry", "n", F.posexplode("total").alias("axis", "x"))
        moved = each.groupBy("part", "entry", "axis").agg(F.sum("x").alias("x"), F.sum("n").alias("n"))
        for r in moved.collect():
            books[r["part"]][r["entry"], r["axis"]] = r["x"] // r["n"]
    return common.arrow_map(blocks, _codes, "vec_id long, label string, code string, error long", books), books


def codebooks_digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components in order of part, entry and position."""
    return hashlib.sha256(",".join(str(x) for book in books for x in book.ravel().tolist()).encode()).hexdigest()


def with_label_error(coded: DataFrame) -> DataFrame:
    """Adds label_error, the errors' sum over equal labels (nulls together); a hot label is dealt over tasks."""
    key = F.coalesce(F.concat(F.lit("="), "label"), F.lit("")).alias("_label")
    rows = coded.select("*", key)
    sums = rows.groupBy("_label").agg(F.sum("error").alias("label_error"), F.count("*").alias("n"))
    return common.split_join(rows, sums.drop("n"), ["_label"], sums.select("_label", "n")).drop("_label")
