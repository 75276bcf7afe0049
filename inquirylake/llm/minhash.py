"""Op 5: near-duplicate documents by b-bit MinHash, bands, and exact confirmation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import anchors, common
from .components import components

#: Minima of a signature, rows of a band, low bits of each minimum that are kept.
MINIMA, ROWS, BITS = 128, 4, 4
BANDS = MINIMA // ROWS
#: Estimates this many standard errors below the threshold are still confirmed.
ERRORS = 6.0
#: Documents of a comparison against one hub, and of one block of a bucket.
HUB, BLOCK = 256, 512
#: Shingles of the sets that a block holds at once, eight bytes each.
SHINGLES = 1 << 22

_dice = np.random.default_rng(20240917)
_MULTIPLY = _dice.integers(1, 1 << 63, MINIMA, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
_ADD = _dice.integers(0, 1 << 63, MINIMA, dtype=np.uint64)
_FIRST_OF_BITS = np.uint64(sum(1 << i for i in range(0, 64, BITS)))
#: A-Z to a-z, other bytes as they are.
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def shingle_sets(data: np.ndarray, bounds: np.ndarray, size: int) -> list[np.ndarray]:
    """Each text's distinct shingles, as sorted 64-bit hashes of ``size`` words in a row.

    data holds the texts' UTF-8 bytes end to end, bounds their offsets.  Words are runs of bytes other than white space (0x20, 0x09 to 0x0D), with A-Z lower-cased.  A
    text of fewer words has one shingle, all its words; one without words has none.
    """
    tokens, _, _, first = anchors.words(_LOWER[data], bounds)
    prefix = anchors.prefixes(tokens)
    whole = anchors.grams(prefix, size)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(whole[a : b - size + 1]))
        elif b > a:
            out.append(anchors.spans(prefix, np.array([a]), np.array([b])))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """The least value of each of the MINIMA hash functions."""
    out = np.full(MINIMA, ~np.uint64(0))
    for at in range(0, len(shingles), 2048):
        values = shingles[at : at + 2048, None] * _MULTIPLY
        values += _ADD
        np.minimum(out, values.min(0), out=out)
    return out


def pack(minima: np.ndarray) -> np.ndarray:
    """The low bits of the minima (taken after mixing), packed into 64-bit words."""
    low = anchors.mix(minima) & np.uint64((1 << BITS) - 1)
    shifts = np.arange(0, 64, BITS, dtype=np.uint64)
    return np.bitwise_or.reduce(low.reshape(-1, 64 // BITS) << shifts, axis=1)


def bands(minima: np.ndarray) -> np.ndarray:
    """A hash of each band's minima and number."""
    rows = minima.reshape(BANDS, ROWS)
    out = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(anchors.BASE)
    for i in range(ROWS):
        out = anchors.mix(out ^ rows[:, i])
    return out


def estimate(packed: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Similarities from counts of unlike packed minima, corrected for equality by chance."""
    unlike = packed ^ others
    for shift in (1, 2):
        unlike = unlike | unlike >> np.uint64(shift)
    same = 1 - np.bitwise_count(unlike & _FIRST_OF_BITS).sum(-1) / MINIMA
    chance = 0.5**BITS
    return (same - chance) / (1 - chance)


def error(similarity: float) -> float:
    """The standard error of an estimate."""
    p = similarity + (1 - similarity) * 0.5**BITS
    return (p * (1 - p) / MINIMA) ** 0.5 / (1 - 0.5**BITS)


def _sketch(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = shingle_sets(*anchors.flat(batch["text"]), size)
        counts = np.array([len(s) for s in sets], np.int64)
        digests = np.zeros((len(sets), 2), np.uint64)
        packed, buckets = [], []
        for i, s in enumerate(sets):
            if len(s):
                digests[i] = anchors.mix(s).sum(), anchors.mix(s ^ np.uint64(anchors.INVERSE)).sum()
            minima = signature(s)
            packed.append(pack(minima).tobytes())
            buckets.append(bands(minima).view(np.int64))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * BANDS), pa.array(np.concatenate(buckets) if buckets else np.zeros(0, np.int64)))
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(counts), pa.array(digests[:, 0].view(np.int64)), pa.array(digests[:, 1].view(np.int64)), pa.array(packed, pa.binary()), lists], ["doc_id", "n_shingles", "d1", "d2", "packed", "buckets"])


def _hopeful(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Of pairs with both packed signatures, those whose estimate may reach the threshold."""
    for batch in batches:
        if batch.num_rows:
            one, two = (np.frombuffer(b"".join(batch[c].to_pylist()), np.uint64).reshape(batch.num_rows, -1) for c in ("packed", "packed_b"))
            yield batch.select(["a", "b", "n"]).filter(pa.array(estimate(one, two) >= least))


def _confirm(batches: Iterator[pa.RecordBatch], size: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Of each hub's documents, those whose sets are similar enough to the hub's (any of its texts).

    A hub's own rows come before its documents, so only its sets are held; the others pass by, a few
    megabytes at a time.
    """
    hub, hubs = None, {}
    for batch in batches:
        a, ids, bodies = np.asarray(batch["a"]), np.asarray(batch["id"]), batch["body"]
        kept = []
        for at, end in _slices(bodies):
            for i, s in enumerate(shingle_sets(*anchors.joined(common.bodies(bodies.slice(at, end - at))), size), at):
                if ids[i] == a[i]:
                    if hub != a[i]:
                        hub, hubs = a[i], {}
                    hubs[s.tobytes()] = s
                    continue
                for own in hubs.values() if hub == a[i] else ():
                    both = len(np.intersect1d(own, s, assume_unique=True))
                    if both and 100 * both >= percent * (len(own) + len(s) - both):
                        kept.append(i)
                        break
        yield pa.RecordBatch.from_arrays([batch["a"].take(pa.array(kept, pa.int64())), batch["id"].take(pa.array(kept, pa.int64()))], ["a", "b"])


def _slices(bodies: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Stretches of texts of a megabyte each, compressed, or of a single longer one."""
    at, held = 0, 0
    for i, n in enumerate(pc.binary_length(bodies).to_pylist()):
        if held and held + n > most:
            yield at, i
            at, held = i, 0
        held += n
    if at < len(bodies):
        yield at, len(bodies)


def _flag(group: pa.Table, least: float) -> pa.Table:
    """Documents of a bucket's blocks that may be similar to one of another component.

    A pair counts only in the first band that both share.
    """
    visitor = np.asarray(group["visitor"])
    ids, part = np.asarray(group["id"]), np.asarray(group["component"])
    packed = np.frombuffer(b"".join(group["packed"].to_pylist()), np.uint64).reshape(len(ids), -1)
    buckets = np.asarray(group["buckets"].combine_chunks().flatten()).reshape(len(ids), BANDS)
    bucket = group["bucket"][0].as_py()
    members = np.flatnonzero(~visitor)
    flagged = np.zeros(len(ids), bool)
    for row in np.flatnonzero(visitor):
        other = members[part[members] != part[row]]
        other = other[estimate(packed[row], packed[other]) >= least]
        shared = buckets[other] == buckets[row]
        other = other[buckets[row][shared.argmax(1)] == bucket] if len(other) else other
        if len(other):
            flagged[row] = True
            flagged[other] = True
    kept = np.unique(ids[flagged])
    return pa.table({"bucket": pa.array(np.full(len(kept), bucket, np.int64)), "id": pa.array(kept)})


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [s.tobytes() for s in shingle_sets(*anchors.joined(common.bodies(batch["body"])), size)]
        yield pa.RecordBatch.from_arrays([batch["id"], pa.array(sets, pa.binary())], ["id", "shingles"])


def _links(group: pa.Table, percent: int) -> pa.Table:
    """Links between a bucket's blocks that join unlike components, by whole sets."""
    visitor = np.asarray(group["visitor"])
    ids, part = np.asarray(group["id"]), np.asarray(group["component"])
    sets = [np.frombuffer(s, np.uint64) for s in group["shingles"].to_pylist()]
    members, visitors = np.flatnonzero(~visitor), np.flatnonzero(visitor)
    out: list[tuple[int, int]] = []
    if len(members) and len(visitors):
        sizes = np.array([len(sets[i]) for i in members])
        vocabulary, at = np.unique(np.concatenate([sets[i] for i in members]), return_inverse=True)
        starts = np.cumsum(sizes) - sizes
        marked = np.zeros(len(vocabulary) + 1, np.int64)
        done: set[tuple[int, int]] = set()
        for row in visitors:
            own = np.searchsorted(vocabulary, sets[row])
            own = own[vocabulary[np.minimum(own, len(vocabulary) - 1)] == sets[row]]
            marked[own] = 1
            both = np.add.reduceat(marked[at], starts)
            marked[own] = 0
            near = (100 * both >= percent * (len(sets[row]) + sizes - both)) & (part[members] != part[row])
            for i in members[near]:
                parts = (min(part[i], part[row]), max(part[i], part[row]))
                if parts not in done:  # one link joins two components
                    done.add(parts)
                    out.append((ids[i], ids[row]))
    a, b = (np.array(x, np.int64) for x in (zip(*out, strict=True) if out else ([], [])))
    return pa.table({"a": pa.array(a), "b": pa.array(b)})


def confirm(pairs: DataFrame, counts: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough; a is compared with many b at once.

    pairs has a, b and n, about how many pairs a has; counts has a and n.
    """
    dealt = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.ceil(F.col("n") / HUB)).cast("int"))
    wanted = dealt.select("a", "salt", F.explode(F.array("a", "b")).alias("id")).distinct()
    with_text = common.split_join(wanted, texts, ["id"], counts.select(F.col("a").alias("id"), F.ceil(F.col("n") / HUB).alias("n")))
    slot = F.shiftrightunsigned(F.xxhash64("a"), 8) + F.col("salt")
    tasks = common.partitions(pairs.sparkSession)
    dealt = with_text.repartitionById(tasks, F.pmod(slot, F.lit(tasks)).cast("int")).sortWithinPartitions("a", "salt", F.col("id") != F.col("a"))
    return common.arrow_map(dealt.select("a", "id", "body"), _confirm, "a long, b long", size, percent).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of (doc_id, text).

    Documents are linked if 100 * intersection >= percent * union of their whole shingle sets.
    Null, empty and wordless texts have no shingles and link with nothing.  Equal sets form one
    class.  Rows that share a doc_id count as that one document, linked by any of its texts.  A
    null doc_id links with nothing and is kept.  An empty table gives no rows; other columns are
    ignored.

    Classes that share a band and whose b-bit estimates may reach the threshold are first confirmed
    against the bucket's smallest one, so a large group costs one comparison a document.  Members of
    a bucket that are still in unlike components are then compared with each other as well, if any
    estimate asks for it, in blocks of bounded size; so no link between components is lost.
    """
    texts = common.with_text(docs)
    sketches = common.checkpoint(common.arrow_map(texts, _sketch, "doc_id long, n_shingles long, d1 long, d2 long, packed binary, buckets array<long>", shingle))
    usable = sketches.where("n_shingles > 0 and doc_id is not null")
    key = ["n_shingles", "d1", "d2"]
    # equal sets have equal signatures, so these may stand among the keys
    classes = common.checkpoint(usable.groupBy(*key, "packed", "buckets").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")))
    signatures = classes.select("rep", "packed")
    banded = classes.select("rep", "n_shingles", F.explode("buckets").alias("bucket"))
    shared = common.checkpoint(banded.groupBy("bucket").agg(F.min("rep").alias("hub"), F.max("rep").alias("last"), F.count("*").alias("n")).where("hub < last"))
    members = common.checkpoint(common.split_join(banded, shared.select("bucket", "hub"), ["bucket"], shared), release=True)
    least = percent / 100 - ERRORS * error(percent / 100)
    pairs = common.checkpoint(members.where("rep > hub").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct())
    counts = common.checkpoint(pairs.groupBy("a").agg(F.count("*").alias("n")))
    hubs = counts.join(signatures.withColumnRenamed("rep", "a"), "a")
    both = common.split_join(pairs, hubs, ["a"], counts).join(signatures.select(F.col("rep").alias("b"), F.col("packed").alias("packed_b")), "b")
    hopeful = common.checkpoint(common.arrow_map(both.select("a", "b", "n", "packed", "packed_b"), _hopeful, "a long, b long, n long", least))
    bodies = common.packed(texts.where("doc_id is not null").select(F.col("doc_id").alias("id"), "text"))
    links = common.checkpoint(confirm(hopeful, counts, bodies, shingle, percent).unionByName(_same_ids(usable, classes, key)), release=True)

    parts = components(links)
    placed = members.groupBy("rep").agg(F.max("n_shingles").alias("shingles")).join(parts.withColumnRenamed("node", "rep"), "rep", "left").select("rep", "shingles", F.coalesce("component", "rep").alias("component"))
    placed = common.checkpoint(placed)
    split = _blocks(members.select("bucket", "rep").join(placed.drop("shingles"), "rep").withColumnRenamed("rep", "id"))
    split = split.join(classes.select(F.col("rep").alias("id"), "packed", "buckets"), "id")
    flagged = common.checkpoint(common.dealt_groups(split, ["bucket", "m", "v"], F.col("slot"), _flag, "bucket long, id long", least).distinct())
    wanted = flagged.select("id").distinct().join(bodies, "id")
    sets = common.arrow_map(wanted, _sets, "id long, shingles binary", shingle).distinct()
    rest = _blocks(flagged.join(placed.withColumnRenamed("rep", "id"), "id"), "shingles").join(sets, "id")
    more = common.dealt_groups(rest, ["bucket", "m", "v"], F.col("slot"), _links, "a long, b long", percent)
    parts = components(links.unionByName(common.checkpoint(more)))

    common.drop_shuffles(docs.sparkSession)
    classed = classes.join(parts.withColumnRenamed("node", "rep"), "rep", "left").select(*key, F.coalesce("component", "rep").alias("component"))
    linked = common.split_join(usable.select("doc_id", *key), classed, key, classes).select("doc_id", "n_shingles", F.col("component").alias("component_id"))
    unlinked = sketches.where("not (n_shingles > 0 and doc_id is not null)").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(unlinked).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _same_ids(usable: DataFrame, classes: DataFrame, key: list[str]) -> DataFrame:
    """Links between a repeated doc_id and the classes that its rows belong to."""
    repeated = usable.groupBy("doc_id").agg(F.min("d1").alias("low"), F.max("d1").alias("high")).where("low < high").select("doc_id")
    rows = usable.join(repeated, "doc_id").select("doc_id", *key).distinct()
    return rows.join(classes.select(*key, "rep"), key).where("rep <> doc_id").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))


def keep_first(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows, with all their columns, of each group's smallest doc_id, once for each of its texts.

    So rows that repeat doc_id and text of another go; rows of a null doc_id all stay; other cases
    as in near_duplicates.  Columns of any names pass through.
    """
    fresh = "kept_"
    while fresh in docs.columns:
        fresh += "_"
    kept = near_duplicates(docs, shingle, percent).where("kept and doc_id is not null").select(F.col("doc_id").alias(fresh)).distinct()
    rows = docs.join(kept, docs["doc_id"] == kept[fresh]).select(*(docs[c] for c in docs.columns))
    once = Window.partitionBy("doc_id", F.xxhash64("text"), F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8"))).orderBy("doc_id")
    rows = rows.withColumn(fresh, F.row_number().over(once)).where(F.col(fresh) == 1).drop(fresh)
    return rows.unionByName(docs.where(docs["doc_id"].isNull()))


def _blocks(rows: DataFrame, weight: str | None = None) -> DataFrame:
    """Members and visitors of buckets that hold several components, dealt so that each pair of
    blocks meets in one group: bucket, m, v, slot, visitor, id, component.

    rows has bucket, id and component.  Pairs within a bucket's largest component need no
    comparison, so its rows don't visit; both sides are cut by their own numbers.  With weight, a
    column of set sizes, blocks are bounded by the sum of those as well.
    """
    rows = common.checkpoint(rows)
    parts = rows.groupBy("bucket", "component").agg(F.count("*").alias("k"), (F.sum(weight) if weight else F.lit(0).cast("long")).alias("w"))
    largest = parts.groupBy("bucket").agg(F.sum("k").alias("n"), F.sum("w").alias("w"), F.max(F.struct("k", "component", "w")).alias("top"), F.count("*").alias("parts")).where("parts > 1")
    cut = lambda n, w: F.greatest(F.ceil(n / BLOCK), F.ceil(w / SHINGLES)).cast("int")
    plan = common.checkpoint(largest.select("bucket", "n", F.col("top.component").alias("base"), cut(F.col("n"), F.col("w")).alias("mb"), cut(F.col("n") - F.col("top.k"), F.col("w") - F.col("top.w")).alias("vb")))
    dealt = common.split_join(rows, plan.drop("n"), ["bucket"], plan)
    block = lambda blocks: F.pmod(F.xxhash64("id"), F.col(blocks)).cast("int")
    each = lambda blocks: F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))
    one = dealt.select("bucket", "vb", block("mb").alias("m"), each("vb").alias("v"), F.lit(False).alias("visitor"), "id", "component")
    two = dealt.where("component <> base").select("bucket", "vb", each("mb").alias("m"), block("vb").alias("v"), F.lit(True).alias("visitor"), "id", "component")
    # a bucket's groups follow one another over the tasks, from a place of its own
    slot = F.shiftrightunsigned(F.xxhash64("bucket"), 8) + F.col("m").cast("long") * F.col("vb") + F.col("v")
    return one.unionByName(two).withColumn("slot", slot).drop("vb")
