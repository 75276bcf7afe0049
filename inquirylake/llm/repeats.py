"""Runs of windows that stand in more than one place; what substring and suffix dedup share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import anchors, common

#: Stands for a null doc_id: before all others.
NO_ID = -(1 << 63)
#: others: further starts of the same content in the same text, which share the run's fate; group:
#: the anchor of a run whose anchor is hot, so that the run is dealt by its content, else 0.
RUN = "anchor long, content long, key long, start int, count int, known boolean, from_key long, from_start int, self boolean, others array<int>, group long"
#: One in so many documents is looked at for hot anchors; anchors that a task counts, and that may
#: be hot, at most; rows of an anchor from which it may be hot.
EVERY, COUNTERS, HOT = 8, 8192, 512


def keyed(docs: DataFrame, more: dict[str, Column] | None = None) -> DataFrame:
    """key (doc_id, never null), text (null: empty), and more columns."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("key"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *(column.alias(name) for name, column in (more or {}).items()))


def batch(keys: np.ndarray, found: tuple[np.ndarray, ...], by_key: bool, hot: np.ndarray | None = None) -> pa.RecordBatch:
    """Runs of a batch of texts as rows; equal ones after the batch's first are known to be repeats.

    Known rows no longer need to meet others, so their anchor becomes one of their own: a run that
    a third of all texts hold reaches the shuffle once for each batch.  With by_key a content that a
    text holds many times is one row.  hot holds anchors (sorted) whose runs are dealt by content.
    """
    anchor, content, text, start, count, own = found
    key = keys[text]
    order = np.lexsort((start, key, content, anchor))
    anchor, content, key, start, count, own = (x[order] for x in (anchor, content, key, start, count, own))
    new = np.ones(len(order), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1])
    first = np.flatnonzero(new)[np.cumsum(new) - 1] if len(order) else np.zeros(0, np.int64)
    known = key > key[first]
    if not by_key:
        known |= (key == key[first]) & (start > start[first])
    from_key, from_start = np.where(known, key[first], 0), np.where(known, start[first], 0)
    if by_key:
        new[1:] |= key[1:] != key[:-1]
    else:
        new[:] = True
    kept = np.flatnonzero(new)
    further = np.diff(np.append(kept, len(order))) - 1
    others = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(further)).astype(np.int32)), pa.array(start[~new].astype(np.int32)), mask=pa.array(further == 0))
    anchor, content, key, start, count, own, known, from_key, from_start = (x[kept] for x in (anchor, content, key, start, count, own, known, from_key, from_start))
    group = np.zeros(len(kept), np.uint64)
    if hot is not None and len(hot):
        is_hot = ~known & (hot[np.minimum(np.searchsorted(hot, anchor), len(hot) - 1)] == anchor)
        group = np.where(is_hot, anchor, group)
        anchor = np.where(is_hot, anchors.mix(anchor ^ anchors.mix(content)), anchor)
    anchor = np.where(known, anchors.mix(key.astype(np.uint64) * np.uint64(anchors.BASE) + start.astype(np.uint64)), anchor)
    content = np.where(known, np.uint64(0), content)
    columns = [anchor.view(np.int64), content.view(np.int64), key, start.astype(np.int32), count.astype(np.int32), known, from_key, from_start.astype(np.int32), own, others, group.view(np.int64)]
    return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in columns], [x.split()[0] for x in RUN.split(", ")])


def count_anchors(runs: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The most frequent anchors of a task's runs with counts (Misra-Gries), and (null) how many runs.

    With COUNTERS counters an anchor's count is too low by at most one in COUNTERS of the runs.
    """
    have, counts, total = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    for rows in runs:
        anchor = rows["anchor"].to_numpy()[~np.asarray(rows["known"])]
        total += len(anchor)
        have, at = np.unique(np.concatenate([have, anchor]), return_inverse=True)
        counts = np.bincount(at, np.concatenate([counts, np.ones(len(anchor), np.int64)]), len(have)).astype(np.int64)
        if len(have) > COUNTERS:
            counts -= np.partition(counts, -COUNTERS - 1)[-COUNTERS - 1]
            have, counts = have[counts > 0], counts[counts > 0]
    yield pa.RecordBatch.from_arrays([pa.array([None, *have.tolist()], pa.int64()), pa.array([total, *counts.tolist()], pa.int64())], ["anchor", "n"])


def hot_anchors(docs: DataFrame, function: Callable, least: int, *args) -> np.ndarray:
    """Anchors that so many runs share that one task should not get them all, sorted.

    They are estimated on one in EVERY documents.  They only say how runs are dealt: a hot anchor's
    runs meet by content instead, and their unlike ones are compared anyway.  An anchor is hot that
    holds more than a quarter of a task's share of all runs, so there are at most COUNTERS / 2.
    """
    tasks = min(4 * common.partitions(docs.sparkSession), COUNTERS // 2)
    some = docs.where(F.pmod(F.xxhash64("key"), F.lit(EVERY)) == 0)
    counted = common.arrow_map(some, function, "anchor long, n long", *args).groupBy("anchor").agg(F.sum("n").alias("n"))
    rows = counted.orderBy(F.col("anchor").isNotNull(), F.desc("n")).limit(COUNTERS // 2 + 1).collect()  # a row for the total, then a bounded number
    total = next((r["n"] for r in rows if r["anchor"] is None), 0)
    hot = [r["anchor"] for r in rows if r["anchor"] is not None and r["n"] * EVERY >= max(least, total * EVERY // tasks)]
    return np.sort(np.array(hot, np.int64).view(np.uint64))


def shared(runs: DataFrame, by_key: bool) -> DataFrame:
    """Runs that are repeats of an earlier one (removed), and first ones whose anchor others share.

    Without by_key also runs whose own windows may equal each other.  All first runs of a hot anchor
    are given out, as they surely have unlike ones beside them.  A run's place is (key, start), or
    with by_key its key alone.
    """
    anchor = Window.partitionBy("anchor")
    content = Window.partitionBy("anchor", "content").orderBy("key", "start")
    first = F.first(F.struct(F.col("key").alias("k"), F.col("start").alias("s"))).over(content)
    alone = (F.col("self") & F.lit(not by_key)) | (F.col("group") != 0)
    rows = runs.withColumns({"n": F.count("*").over(anchor), "low": F.min("content").over(anchor), "high": F.max("content").over(anchor)}).where(F.expr("known or n > 1") | alone)
    rows = rows.withColumn("first", first)
    later = (F.col("key") > F.col("first.k")) | (F.lit(not by_key) & (F.col("start") > F.col("first.s")))
    rows = rows.withColumn("removed", F.col("known") | later).where(F.expr("removed or low <> high") | alone)
    if by_key:
        rows = rows.withColumn("start", F.explode(F.concat(F.array("start"), F.coalesce("others", F.array().cast("array<int>")))))
    return rows.select(
        F.when(F.col("group") != 0, F.col("group")).otherwise(F.col("anchor")).alias("anchor"),
        "key",
        "start",
        "count",
        "removed",
        F.when(F.col("known"), F.col("from_key")).otherwise(F.col("first.k")).alias("from_key"),
        F.when(F.col("known"), F.col("from_start")).otherwise(F.col("first.s")).alias("from_start"),
        (F.col("group") != 0).alias("hot"),
    )


def at_places(docs: DataFrame, places: DataFrame, how: str = "inner") -> DataFrame:
    """Texts, each with the list (spans) of what is wanted of it: places has key and further columns."""
    listed = places.groupBy("key").agg(F.collect_list(F.struct(*[c for c in places.columns if c != "key"])).alias("spans"))
    return docs.join(listed, "key", how)


def listed(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Text number and place of each window in column spans of (start, count, ...)."""
    spans = batch["spans"]
    owner = np.repeat(np.arange(len(spans)), np.asarray(spans.value_lengths().fill_null(0), np.int64))
    flat = spans.flatten()
    start, size = np.asarray(flat.field(0), np.int64), np.asarray(flat.field(1), np.int64)
    step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    return np.repeat(owner, size), np.repeat(start, size) + step


def windows(keys: np.ndarray, at: np.ndarray, h1: np.ndarray, h2: np.ndarray, by_key: bool) -> pa.RecordBatch:
    """Single windows as runs of one, under two hashes, those known to be repeats marked."""
    return batch(keys, (h1, h2, np.arange(len(keys)), at, np.ones(len(at), np.int64), np.zeros(len(at), bool)), by_key)


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The maximal spans that these spans cover."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.r_[True, starts[1:] > ends[:-1]]
    return starts[new], ends[np.r_[np.flatnonzero(new)[1:] - 1, len(ends) - 1]]
