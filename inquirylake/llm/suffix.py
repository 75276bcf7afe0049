"""Op 4: repeated byte strings by longest-previous-factor arrays over suffix order."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import anchors, common, repeats

#: Bytes of the gram that picks a run's anchor; bytes of slices whose suffixes are ordered at once;
#: runs of an anchor from which they are dealt over many tasks.
GRAM, CHUNK, HOT = 32, 2 << 20, repeats.HOT
SLICE = "anchor long, salt int, hot boolean, key long, start int, count int, body binary"


class Suffixes:
    """Ranks of the strings of 8, 16, 32, ... bytes at each place, as far as ``reach`` needs."""

    def __init__(self, data: np.ndarray, reach: int):
        self.depth = 8
        while self.depth < reach:
            self.depth *= 2
        padded = np.concatenate([data, np.zeros(2 * self.depth, np.uint8)])
        eight = padded.astype(np.uint64)
        for shift in (1, 2, 4):
            eight = (eight[:-shift] << np.uint64(8 * shift)) | eight[shift:]
        self.eight = eight
        self.ranks = {8: np.unique(eight, return_inverse=True)[1].astype(np.int32)}
        depth = 8
        while depth < self.depth:
            half = self.ranks[depth].astype(np.int64)
            pairs = half[:-depth] * np.int64(len(half) + 1) + half[depth:]
            depth *= 2
            self.ranks[depth] = np.unique(pairs, return_inverse=True)[1].astype(np.int32)

    def order(self, at: np.ndarray) -> np.ndarray:
        """Indexes of ``at`` in suffix order; those equal as far as depth by place."""
        return np.argsort(self.ranks[self.depth][at], kind="stable")

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many bytes are equal from each pair of places on, up to depth."""
        out = np.zeros(len(a), np.int64)
        for size in sorted(self.ranks, reverse=True):
            same = (out < self.depth) & (self.ranks[size][a + out] == self.ranks[size][b + out])
            out += size * same
        unlike = self.eight[a + out] ^ self.eight[b + out]
        for bits in range(8, 65, 8):  # equal leading bytes of the last eight
            out += (out < self.depth) & (unlike < np.uint64(1 << (64 - bits)))
        return np.minimum(out, self.depth)


def previous_smaller(x: np.ndarray) -> np.ndarray:
    """For each index the nearest one before it with a smaller value, or -1, by jumping over greater ones."""
    out = np.arange(len(x)) - 1
    open_ = np.flatnonzero((out >= 0) & (x[out] >= x))
    while len(open_):
        out[open_] = out[out[open_]]
        to = out[open_]
        open_ = open_[(to >= 0) & (x[to] >= x[open_])]
    return out


def factors(data: np.ndarray, at: np.ndarray, place: np.ndarray, reach: int, until: np.ndarray | None = None) -> np.ndarray:
    """The longest previous factor of each position in ``at``: the longest string, measured as far as
    ``reach`` at least, that starts both there and at one of ``at`` with a smaller ``place``.

    In suffix order the previous and the next position with a smaller place are the nearest
    earlier suffixes; one of both shares the longest prefix.  ``until`` tells where the text of each
    position ends, if data holds several; no factor goes on behind that, here or at its source.
    """
    if not len(at):
        return np.zeros(0, np.int64)
    suffixes = Suffixes(data, reach)
    order = suffixes.order(at)
    value = place[order]
    out = np.zeros(len(at), np.int64)
    back = len(order) - 1 - previous_smaller(value[::-1])[::-1]
    for near in (previous_smaller(value), np.where(back < len(order), back, -1)):
        has = np.flatnonzero(near >= 0)
        own, source = order[has], order[near[has]]
        shared = suffixes.common(at[own], at[source])
        if until is not None:
            shared = np.minimum(shared, np.minimum(until[own] - at[own], until[source] - at[source]))
        out[own] = np.maximum(out[own], shared)
    return out


def longest_previous_factors(text: bytes) -> list[int]:
    """lpf[i]: the longest string that starts both at i and earlier."""
    at = np.arange(len(text))
    return np.minimum(factors(np.frombuffer(text, np.uint8), at, at, len(text)), len(text) - at).tolist()


def first_of_equal(data: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """For each place in ``at`` (ascending), the index of the first place with the same ``width`` bytes."""
    if not len(at):
        return np.zeros(0, np.int64)
    strings = np.lib.stride_tricks.sliding_window_view(data, width)[at]
    first, inverse = np.unique(strings, axis=0, return_index=True, return_inverse=True)[1:]
    return first[inverse.ravel()]


def _runs(batches: Iterator[pa.RecordBatch], width: int, hot: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """Runs of windows; their content is a cryptographic digest of their bytes, not only a sum."""
    for batch in batches:
        data, bounds = anchors.flat(batch["text"])
        anchor, content, text, start, count, own = anchors.runs(data, bounds, width, min(GRAM, width), anchors.BYTES)
        bytes_, first = memoryview(data), bounds[text] + start
        digests = [hashlib.blake2b(bytes_[a:b], digest_size=8).digest() for a, b in zip(first.tolist(), (first + count + width - 1).tolist(), strict=True)]
        yield repeats.batch(batch["key"].to_numpy(), (anchor, np.frombuffer(b"".join(digests), "<u8"), text, start, count, own), False, hot)


def _counts(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    return repeats.count_anchors(_runs(batches, width))


def _slices(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """The bytes of the runs listed for each text."""
    for batch in batches:
        out: list[tuple] = []
        for key, body, spans in zip(batch["key"].to_pylist(), common.bodies(batch["body"]), batch["spans"].to_pylist(), strict=True):
            for s in spans:
                end = s["start"] + s["count"] + width - 1
                if end <= len(body):
                    out.append((s["anchor"], s["salt"], s["hot"], key, s["start"], s["count"], body[s["start"] : end]))
        columns = list(zip(*out, strict=True)) or [[]] * 7
        types = (pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], [x.split()[0] for x in SLICE.split(", ")])


def _hashed(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Single windows of the runs listed for each text, under two hashes."""
    for batch in batches:
        data, bounds = anchors.joined(common.bodies(batch["body"]))
        one, two = anchors.both_grams(anchors.BYTES[data], width)
        text, at = repeats.listed(batch)
        place = bounds[text] + at
        keep = place < bounds[text + 1] - width + 1
        text, at, place = text[keep], at[keep], place[keep]
        yield repeats.windows(batch["key"].to_numpy()[text], at, one[place], two[place], False)


def _chunk(rows: pa.Table, split: np.ndarray, width: int) -> pa.RecordBatch:
    """Spans that repeat something earlier within these slices, by longest previous factors; and of
    anchors that other chunks hold as well, the runs of windows that don't (left, with their count)."""
    key, start, count = (rows[c].to_numpy().astype(np.int64) for c in ("key", "start", "count"))
    sizes = count + width - 1
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"".join(rows["body"].to_pylist()), np.uint8)
    owner = np.repeat(np.arange(len(count)), count)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    at = (ends - sizes)[owner] + step
    place = (np.unique(key, return_inverse=True)[1] << 32)[owner] + start[owner] + step
    length = factors(data, at, place, width, ends[owner])
    covered = length >= width
    fresh = np.r_[True, owner[1:] != owner[:-1]] if len(owner) else np.zeros(0, bool)

    def stretches(wanted: np.ndarray) -> np.ndarray:
        return np.flatnonzero(wanted & (fresh | ~np.r_[False, wanted[:-1]])) if len(wanted) else np.zeros(0, np.int64)

    at_span, at_left = stretches(covered), stretches(~covered & split[owner])
    position = start[owner] + step
    until = np.maximum.reduceat(np.where(covered, position + length, 0), at_span) if len(at_span) else at_span
    last = np.flatnonzero(np.r_[fresh[1:] | ~(~covered & split[owner])[1:], True] & (~covered & split[owner])) if len(owner) else at_left
    columns = [np.concatenate([key[owner[at_span]], key[owner[at_left]]]), np.concatenate([position[at_span], position[at_left]]).astype(np.int32), np.concatenate([until - position[at_span], last - at_left + 1]).astype(np.int32), np.repeat([False, True], [len(at_span), len(at_left)])]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["key", "start", "size", "left"])


def _factors(batches: Iterator[pa.RecordBatch], width: int, chunk: int) -> Iterator[pa.RecordBatch]:
    """Repeats within slices that come ordered by anchor, salt, key and start, in bounded chunks.

    A chunk ends between anchors if it can, but never holds more than ``chunk`` bytes and a slice;
    windows of an anchor that is cut, or dealt over several tasks, go on to meet the others.
    """
    held: list[pa.RecordBatch] = []
    size, last, cut = 0, None, False

    def out(following) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        anchor = rows["anchor"].to_numpy()
        split = rows["hot"].to_numpy().copy()
        split |= (anchor == anchor[0]) & cut
        split |= (anchor == anchor[-1]) & (following == anchor[-1])
        return _chunk(rows, split, width)

    for batch in batches:
        anchor, at = batch["anchor"].to_numpy(), 0
        lengths = batch["count"].to_numpy().astype(np.int64) + width - 1
        for i, (own, length) in enumerate(zip(anchor.tolist(), lengths.tolist(), strict=True)):
            if size and (size + length > chunk or own != last and size > chunk // 2):
                if i > at:
                    held.append(batch.slice(at, i - at))
                yield out(own)
                held, size, at, cut = [], 0, i, own == last
            size += length
            last = own
        if len(anchor) > at:
            held.append(batch.slice(at))
    if held:
        yield out(None)


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, removed, spans_left, bodies = [], [], [], []
        for body, spans in zip(common.bodies(batch["body"]), batch["spans"].to_pylist(), strict=True):
            starts = ends = np.zeros(0, np.int64)
            if spans:
                starts = np.array([s["start"] for s in spans], np.int64)
                ends = np.minimum(starts + np.array([s["size"] for s in spans], np.int64), len(body))
                starts, ends = repeats.merged(starts[starts < ends], ends[starts < ends])
            counts.append(len(body))
            removed.append(int((ends - starts).sum()))
            spans_left.append(len(starts))
            edges = [0, *np.stack([starts, ends], 1).ravel().tolist(), len(body)]
            bodies.append(b"".join(body[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
        yield pa.RecordBatch.from_arrays([batch["key"], *(pa.array(x, pa.int64()) for x in (counts, removed, spans_left)), pa.array(bodies, pa.binary())], ["key", "n_bytes", "n_removed", "n_spans", "kept"])


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _kept(batches):
        digests = pa.array([hashlib.sha256(body).hexdigest() for body in batch["kept"].to_pylist()])
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], digests], ["key", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def later_copies(docs: DataFrame, texts: DataFrame, width: int = 100, hot: int = HOT, chunk: int = CHUNK) -> DataFrame:
    """key, start, size of spans (not yet merged) that ``width``-byte strings cover which start earlier.

    Runs of windows with one anchor are met with equal runs whole, by a digest of their bytes.  Of
    runs that share an anchor but differ, the bytes are gathered by anchor and searched by longest
    previous factors, in chunks of bounded size; an anchor with ``hot`` runs or more may be dealt over
    all tasks.  What is left of an anchor in each of several chunks, at most one window of each
    content, then meets by 128 bits of hash.
    """
    tasks = common.partitions(docs.sparkSession)
    found = common.checkpoint(repeats.shared(common.arrow_map(docs, _runs, repeats.RUN, width, repeats.hot_anchors(docs, _counts, hot, width)), False))
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("key", "start"), F.lit(tasks))).otherwise(0).cast("int").alias("salt")
    unlike = found.where("not removed").select("key", "start", "count", "anchor", "hot", salt)
    slices = common.arrow_map(repeats.at_places(texts, unlike), _slices, SLICE, width)
    ordered = slices.repartition(tasks, "anchor", "salt").sortWithinPartitions("anchor", "salt", "key", "start")
    searched = common.checkpoint(common.arrow_map(ordered, _factors, "key long, start int, size int, left boolean", width, chunk), release=True)
    common.drop_shuffles(docs.sparkSession)
    left = searched.where("left").select("key", "start", F.col("size").alias("count"))
    single = common.arrow_map(repeats.at_places(texts, left), _hashed, repeats.RUN, width)
    whole = found.where("removed").unionByName(repeats.shared(single, False).where("removed"))
    return whole.select("key", "start", (F.col("count") + width - 1).alias("size")).unionByName(searched.where("not left").drop("left"))


def dedup(docs: DataFrame, width: int = 100, digest: bool = False, hot: int = HOT, chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (or with digest kept_sha256) for each row.

    Removes each UTF-8 byte that a ``width``-byte string covers which also starts earlier: in a
    document of smaller doc_id, or earlier in the same one.  Strings are judged on the input;
    matches never cross documents; the first copy stays.  kept is binary, as a cut may split a
    character.  Null, empty and short texts lose nothing.  A null doc_id comes before all others.
    Rows that share a doc_id are one document: what is repeated in one text is taken from each as
    far as it reaches.  An empty table gives no rows; other columns are ignored.
    """
    keyed = repeats.keyed(docs)
    texts = common.packed(keyed)
    function, last = (_digested, "kept_sha256 string") if digest else (_kept, "kept binary")
    rows = common.arrow_map(repeats.at_places(texts, later_copies(keyed, texts, width, hot, chunk), "left"), function, f"key long, n_bytes long, n_removed long, n_spans long, {last}")
    return rows.select(F.when(F.col("key") != repeats.NO_ID, F.col("key")).alias("doc_id"), "n_bytes", "n_removed", "n_spans", last.split()[0])
