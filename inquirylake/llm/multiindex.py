"""Op 9: near-duplicate vectors through an inverted multi-index."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .components import components

#: Rows that the codebooks are fitted on at most, those with the least hash; members and visitors
#: of one comparison; the share of neighbours at the threshold that traversal is to reach.
SAMPLE, MEMBERS, VISITORS, RECALL = 8192, 2048, 8192, 0.999


def codewords(rows: int) -> int:
    """Words of each half's codebook: about 800 rows for each pair of words, within 4 and 256."""
    return max(4, min(256, int(np.ceil((rows / 800) ** 0.5))))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaling by the largest component first keeps squares finite."""
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def kmeans(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    dice = np.random.default_rng(seed)
    words = x[dice.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(12):
        near = ((words**2).sum(1) - 2 * x @ words.T).argmin(1)
        for j in range(len(words)):
            if (own := near == j).any():
                words[j] = x[own].mean(0)
    return words


class Half:
    """A codebook of one half: nearest word, and how far a vector is from another word's region."""

    def __init__(self, words: np.ndarray):
        self.words = words
        between = np.sqrt(((words[:, None] - words[None]) ** 2).sum(2))
        self.between = np.where(between == 0, 1.0, 2 * between)

    def look(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest word, and the squared distance to each word's bisecting plane."""
        away = (x**2).sum(1)[:, None] - 2 * x @ self.words.T + (self.words**2).sum(1)
        near = away.argmin(1)
        return near, ((away - away[np.arange(len(x)), near][:, None]) / self.between[near]) ** 2


class Index:
    """Two codebooks whose words form a grid of cells; cells are visited in order of distance."""

    def __init__(self, sample: np.ndarray, rows: int, threshold: float, recall: float = RECALL, seed: int = 5):
        self.split = sample.shape[1] // 2
        k = codewords(rows)
        self.halves = [Half(kmeans(part, k, seed + i)) for i, part in enumerate((sample[:, : self.split], sample[:, self.split :]))]
        self.reach = self._reach(sample[:4096], threshold, recall, seed)

    def look(self, x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        return [half.look(part) for half, part in zip(self.halves, (x[:, : self.split], x[:, self.split :]), strict=True)]

    def _reach(self, x: np.ndarray, threshold: float, recall: float, seed: int) -> float:
        """How far traversal must go for neighbours just at the threshold, the farthest that count."""
        noise = np.random.default_rng([seed, 77]).normal(size=x.shape)  # a stream of its own
        noise -= (noise * x).sum(1)[:, None] * x
        noise /= np.linalg.norm(noise, axis=1)[:, None] + 1e-12
        other = threshold * x + np.sqrt(max(0.0, 1 - threshold**2)) * noise
        at = np.arange(len(x))
        need = sum(far[at, near] for (_, far), (near, _) in zip(self.look(x), self.look(other), strict=True))
        return float(np.quantile(need, recall)) + 1e-9

    def cells(self, x: np.ndarray) -> Iterator[list[tuple[int, int]]]:
        """The cells that each vector visits, nearest first (multi-sequence); the first is its own."""
        (_, far1), (_, far2) = self.look(x)
        for a, b in zip(far1, far2, strict=True):
            rows, cols = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
            heap, seen, out = [(a[rows[0]] + b[cols[0]], 0, 0)], {(0, 0)}, []
            while heap:
                cost, i, j = heapq.heappop(heap)
                if cost > self.reach:
                    break
                out.append((int(rows[i]), int(cols[j])))
                for step in ((i + 1, j), (i, j + 1)):
                    if step[0] < len(rows) and step[1] < len(cols) and step not in seen:
                        seen.add(step)
                        heapq.heappush(heap, (a[rows[step[0]]] + b[cols[step[1]]], *step))
            yield out


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(-1, dims)


def _visits(batches: Iterator[pa.RecordBatch], index: Index, dims: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            cells = [[c1 << 16 | c2 for c1, c2 in x] for x in index.cells(unit(_matrix(batch["embedding"], dims)))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.list_(pa.int32()))], [*batch.schema.names, "cells"])


def blocks(linked: np.ndarray) -> np.ndarray:
    """The component, as its first member, of each member of a symmetric relation."""
    at = np.arange(len(linked))
    label = at.copy()
    while True:
        new = np.where(linked, label[None, :], len(label)).min(1, initial=len(label)) if len(label) else label
        new = np.minimum(new, label)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _listed(cells: np.ndarray, sizes: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Whether each row's list of cells holds each of the wanted ones (sorted)."""
    seen = np.isin(cells, wanted)
    out = np.zeros((len(sizes), len(wanted)), bool)
    out[np.repeat(np.arange(len(sizes)), sizes)[seen], np.searchsorted(wanted, cells[seen])] = True
    return out


def _compare(group: pa.Table, dims: int, threshold: float) -> pa.Table:
    """Visitors against members: counts of links, and an edge to each component that is linked.

    Only members whose own cell the visitor visits count.  A member that doesn't visit the visitor's
    own cell has its links counted here too.
    """
    member = np.asarray(group["member"])
    ids, copies = np.asarray(group["rep"]), np.asarray(group["copies"])
    vectors = unit(_matrix(group["embedding"].combine_chunks(), dims))
    order = np.flatnonzero(member)[np.argsort(ids[member], kind="stable")]
    m, q = vectors[order], vectors[~member]
    m_ids, q_ids = ids[order], ids[~member]
    cells = group["cells"].combine_chunks()
    sizes, listed = np.asarray(cells.value_lengths(), np.int64), np.asarray(cells.flatten())
    owns = listed[np.cumsum(sizes) - sizes]
    own, own_at = np.unique(owns[~member], return_inverse=True)
    visited, q_copies = _listed(listed, sizes, own)[order], copies[~member]
    held, held_at = np.unique(owns[order], return_inverse=True)
    visits = _listed(listed, sizes, held)[~member]
    part = blocks(m @ m.T >= threshold)
    by_part = np.argsort(part, kind="stable")
    part_ids, starts = np.unique(part[by_part], return_index=True)
    out = {"rep": [], "links": [], "to": []}
    if len(m_ids):
        for at in range(0, len(q_ids), 1024):
            near = q[at : at + 1024] @ m.T >= threshold
            near &= (q_ids[at : at + 1024, None] != m_ids[None]) & visits[at : at + 1024, held_at]
            links = near @ copies[order]
            rows, parts = np.nonzero(np.logical_or.reduceat(near[:, by_part], starts, axis=1))
            first = np.r_[True, rows[1:] != rows[:-1]] if len(rows) else np.zeros(0, bool)
            out["rep"].append(q_ids[at : at + 1024][rows])
            out["links"].append(np.where(first, links[rows], 0))
            out["to"].append(m_ids[part_ids[parts]])
            unseen = near & ~visited[:, own_at[at : at + 1024]].T
            back = np.flatnonzero(unseen.any(0))
            out["rep"].append(m_ids[back])
            out["links"].append(q_copies[at : at + 1024] @ unseen[:, back])
            out["to"].append(q_ids[at : at + 1024][unseen[:, back].argmax(0)])
    none = [np.zeros(0, np.int64)]
    return pa.table({k: pa.array(np.concatenate(v or none).astype(np.int64)) for k, v in out.items()})


def _compare_all(group: pa.Table, threshold: float) -> pa.Table:
    """As _compare, for the few classes of one label and length: each with all others."""
    ids, copies = np.asarray(group["rep"]), np.asarray(group["copies"])
    near = _near(group["embedding"].combine_chunks(), threshold)
    part = blocks(near)
    np.fill_diagonal(near, False)
    linked = np.flatnonzero(near.any(1))
    return pa.table({"rep": pa.array(ids[linked]), "links": pa.array((near @ copies)[linked]), "to": pa.array(ids[part[linked]])})


def _near(vectors: pa.Array, threshold: float) -> np.ndarray:
    units = unit(_matrix(vectors, len(vectors[0])))
    return units @ units.T >= threshold


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, sample: int = SAMPLE) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of (vec_id, embedding, label).

    Only rows of equal, non-null labels are compared.  Null or zero vectors, those with null or
    non-finite components or of no components, and rows with a null label or vec_id link with
    nothing; vectors of unlike lengths don't link either.  The most common length and each that has
    more than a block's classes get an index of their own; what there is of other lengths is
    compared whole, all lengths in one job.  Equal vectors of a label are one class:
    all its rows link with each other and have the same other links.  An empty table gives no rows;
    other columns are ignored.

    The codebooks are fitted on at most ``sample`` classes; all classes are indexed.  Cells are
    compared in blocks of members and visitors, so no task holds a large cell whole.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").cast("string").alias("label"))
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists("embedding", lambda x: x != 0)
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    digest = [F.xxhash64("embedding").alias("d1"), F.xxhash64(F.lit(1), "embedding").alias("d2")]
    classes = rows.where("usable").groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    classes = common.checkpoint(classes.select("*", *digest))
    lengths = common.checkpoint(classes.groupBy(F.size("embedding").alias("dims")).agg(F.count("*").alias("n")))
    indexed = {r["dims"]: r["n"] for r in [*lengths.where(F.col("n") > MEMBERS).collect(), *lengths.orderBy(F.desc("n"), "dims").limit(1).collect()]}
    results = None
    if indexed:
        few = classes.where(~F.size("embedding").isin(*indexed)).select("label", F.size("embedding").alias("dims"), "rep", "copies", "embedding")
        results = common.arrow_groups(few, ["label", "dims"], _compare_all, "rep long, links long, to long", threshold)
    for dims, n in sorted(indexed.items()):
        some = classes.where(F.size("embedding") == dims)
        taken = some.orderBy(F.xxhash64("rep", "label"), "rep").limit(sample).select("embedding").toArrow()["embedding"]
        index = Index(unit(_matrix(taken.combine_chunks(), dims)), n, threshold)
        found = _links(some, index, dims, threshold)
        results = results.unionByName(found)
    if results is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    results = common.checkpoint(results)
    linked = results.groupBy(F.col("rep")).agg(F.sum("links").alias("links"))
    parts = components(results.select(F.col("rep").alias("a"), F.col("to").alias("b")))
    known = classes.join(linked, "rep", "left").join(parts.withColumnRenamed("node", "rep"), "rep", "left")
    known = known.select("label", "d1", "d2", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component"))
    asked = rows.where("usable").select("vec_id", "label", *digest)
    usable_rows = common.split_join(asked, known, ["label", "d1", "d2"], classes.withColumnRenamed("copies", "n")).select("vec_id", "n_links", F.col("component").alias("component_id"))
    rest = rows.where(~F.col("usable")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return usable_rows.unionByName(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _links(classes: DataFrame, index: Index, dims: int, threshold: float) -> DataFrame:
    """rep, links, to: links in a block (each pair once for either end), and one node of each linked part.

    A label's cells are put together in their order, or cut, to blocks of about MEMBERS rows.  What
    is dealt are numbers; a vector crosses the shuffle once for each block that it visits.
    """
    numbered = classes.select(F.monotonically_increasing_id().alias("number"), "rep", "label", "copies", "embedding")
    vectors = common.checkpoint(common.arrow_map(numbered, _visits, "number long, rep long, label string, copies long, embedding array<double>, cells array<int>", index, dims))
    visits = vectors.select("number", "label", F.posexplode("cells").alias("at", "cell"))
    sizes = common.checkpoint(visits.groupBy("label", "cell").agg(F.count_if(F.col("at") == 0).alias("members"), F.count("*").alias("n")))
    before = Window.partitionBy("label").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as the grid has cells at most
    first = F.floor(F.coalesce(F.sum("members").over(before), F.lit(0)) / MEMBERS).cast("int")
    cells = sizes.where("members > 0").select("label", "cell", first.alias("first"), F.ceil(F.col("members") / MEMBERS).cast("int").alias("blocks"))
    placed = common.split_join(visits, cells, ["label", "cell"], sizes)
    own = F.max(F.when(F.col("at") == 0, F.col("first") + F.pmod(F.xxhash64("number"), F.col("blocks")).cast("int")))
    lists = placed.groupBy("number", "label").agg(F.flatten(F.collect_set(F.sequence(F.col("first"), F.col("first") + F.col("blocks") - 1))).alias("to"), own.alias("own"))
    lists = common.checkpoint(lists.select("number", "label", "own", F.explode(F.array_distinct("to")).alias("block")))
    asked = common.checkpoint(lists.groupBy("label", "block").agg(F.count("*").alias("n"))).withColumn("qb", F.ceil(F.col("n") / VISITORS).cast("int"))
    members = lists.where("block = own").withColumn("member", F.lit(True))
    dealt = common.split_join(lists.withColumn("member", F.lit(False)).unionByName(members).drop("own"), asked.drop("n"), ["label", "block"], asked)
    q = F.when(F.col("member"), F.sequence(F.lit(0), F.col("qb") - 1)).otherwise(F.array(F.pmod(F.xxhash64("number", F.lit(1)), F.col("qb")).cast("int")))
    rows = dealt.select("number", "block", "member", F.explode(q).alias("q")).join(vectors, "number")
    return common.arrow_groups(rows.select("label", "block", "q", "member", "rep", "copies", "embedding", "cells"), ["label", "block", "q"], _compare, "rep long, links long, to long", dims, threshold)
