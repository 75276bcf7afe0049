"""Connected components of an edge list by alternating star operations."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


#: Edges that one task may finish.
FEW = 1 << 20


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of these edges and the smallest node of each one's component."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[left], label[right])
        before = label.copy()
        np.minimum.at(label, label[left], least)
        np.minimum.at(label, label[right], least)
        np.minimum.at(label, left, least)
        np.minimum.at(label, right, least)
        label = label[label]
        if np.array_equal(before, label):
            return nodes, nodes[label]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nodes, least = roots(batch["a"].to_numpy(), batch["b"].to_numpy())
        keep = nodes != least
        yield pa.RecordBatch.from_arrays([pa.array(nodes[keep]), pa.array(least[keep])], ["a", "b"])


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    edges = pa.Table.from_batches(batches, pa.schema([("a", pa.int64()), ("b", pa.int64())]))
    nodes, least = roots(edges["a"].to_numpy(), edges["b"].to_numpy())
    for at in range(0, len(nodes), 65536):
        yield pa.RecordBatch.from_arrays([pa.array(nodes[at : at + 65536]), pa.array(least[at : at + 65536])], ["node", "component"])


def components(edges: DataFrame, few: int = FEW) -> DataFrame:
    """node, component (smallest node reachable) for each node that has an edge to another.

    edges has long columns a and b.  Loops and repeated edges change nothing; null ends are
    dropped.  Each batch of edges is first contracted where it lies.  If at most ``few`` edges are
    left, 16 bytes each, one task finishes them; else rounds of large stars (greater neighbours
    move to the least neighbour) and small stars (a node and its lesser neighbours move to the
    least of them) run until each node points to its component.  Each round is checkpointed.
    """
    edges = edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = common.checkpoint(common.arrow_map(edges, _contract, "a long, b long"))
    if edges.count() <= few:
        return common.checkpoint(common.arrow_map(edges.coalesce(1), _gather, "node long, component long"))
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b").where("a <> b").distinct()
        edges = common.checkpoint(small)
        ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        # done when no node points to two others, nor to one that points on itself
        open_ = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or (up = 1 and down = 1)")
        if not open_.limit(1).count():
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
