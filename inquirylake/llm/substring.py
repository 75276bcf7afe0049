"""Op 7: repeated passages, as compacted paths of a De Bruijn graph of token k-mers."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import anchors, common, repeats

#: Words of the gram that picks a run's anchor.
GRAM = 5


def _runs(batches: Iterator[pa.RecordBatch], width: int, hot: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tokens, _, _, bounds = anchors.words(*anchors.flat(batch["text"]))
        yield repeats.batch(batch["key"].to_numpy(), anchors.runs(tokens, bounds, width, min(GRAM, width)), True, hot)


def _counts(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    return repeats.count_anchors(_runs(batches, width))


def _edges(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Single edges of the runs listed for each text, under two hashes."""
    for batch in batches:
        tokens, _, _, bounds = anchors.words(*anchors.joined(common.bodies(batch["body"])))
        one, two = anchors.both_grams(tokens, width)
        text, at = repeats.listed(batch)
        place = bounds[text] + at
        keep = place < bounds[text + 1] - width + 1  # another text of the same doc_id may be shorter
        text, at, place = text[keep], at[keep], place[keep]
        yield repeats.windows(batch["key"].to_numpy()[text], at, one[place], two[place], True)


def _nodes(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """The nodes that each listed run of edges leaves and enters, hashes of width - 1 words, and its first and last edge."""
    for batch in batches:
        tokens, _, _, bounds = anchors.words(*anchors.joined(common.bodies(batch["body"])))
        prefix = anchors.prefixes(tokens)
        nodes = anchors.grams(prefix, width - 1) if width > 1 else np.zeros(len(tokens) + 1, np.uint64)
        edges = anchors.grams(prefix, width)
        spans = batch["spans"]
        text = np.repeat(np.arange(len(spans)), np.asarray(spans.value_lengths().fill_null(0), np.int64))
        start, count = (np.asarray(spans.flatten().field(i), np.int64) for i in (0, 1))
        place = bounds[text] + start
        fits = place + count + width - 1 <= bounds[text + 1]
        text, start, count, place = text[fits], start[fits], count[fits], place[fits]
        columns = [batch["key"].to_numpy()[text], start.astype(np.int32), *(x.view(np.int64) for x in (nodes[place], nodes[place + count], edges[place], edges[place + count - 1]))]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["key", "start", "tail", "head", "first", "last"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of the words at each place that is listed."""
    for batch in batches:
        out: list[tuple] = []
        for key, body, spans in zip(batch["key"].to_pylist(), common.bodies(batch["body"]), batch["spans"].to_pylist(), strict=True):
            words = body.split()
            out += [(key, s["start"], s["words"], hashlib.blake2b(b" ".join(words[s["start"] : s["start"] + s["words"]]), digest_size=16).digest()) for s in spans if s["start"] + s["words"] <= len(words)]
        columns = list(zip(*out, strict=True)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int32(), pa.binary()), strict=True)], ["key", "start", "words", "digest"])


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of each text, before it any carried columns; an untouched text stays as it is."""
    for batch in batches:
        counts, removed, texts = [], [], []
        for body, spans in zip(common.bodies(batch["body"]), batch["spans"].to_pylist(), strict=True):
            words = body.split()
            counts.append(len(words))
            if spans:
                starts = np.array([s["start"] for s in spans], np.int64)
                starts, ends = repeats.merged(starts, starts + np.array([s["words"] for s in spans], np.int64))
                for a, b in zip(starts[::-1].tolist(), ends[::-1].tolist(), strict=True):
                    del words[a:b]
            removed.append(counts[-1] - len(words))
            texts.append((b" ".join(words) if removed[-1] else body).decode())
        carried = [name for name in batch.schema.names if name.startswith("carried")]
        columns = [batch["key"], pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.string()), *(batch[name] for name in carried)]
        yield pa.RecordBatch.from_arrays(columns, ["key", "n_words", "n_removed", "kept_text", *carried])


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _kept(batches):
        digests = pa.array([hashlib.sha256(b" ".join(text.encode().split())).hexdigest() for text in batch["kept_text"].to_pylist()])
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], digests], ["key", "n_words", "n_removed", "kept_sha256"])


def branching(repeated: DataFrame, bodies: DataFrame, width: int) -> DataFrame:
    """key, start of repeated runs whose path can't go on from the run before: the node between them branches.

    The graph's edges are the repeated ones.  A node branches if unlike edges enter it, or unlike ones
    leave it; edges are told by their hash, so it doesn't matter at which of their places they are read.
    """
    edges = common.checkpoint(common.arrow_map(repeats.at_places(bodies, repeated.select("key", "start", "count")), _nodes, "key long, start int, tail long, head long, first long, last long", width), release=True)
    leaving = F.struct(F.col("tail").alias("node"), F.col("first").alias("edge"), F.lit(1).alias("out"))
    entering = F.struct(F.col("head").alias("node"), F.col("last").alias("edge"), F.lit(0).alias("out"))
    ends = edges.select(F.explode(F.array(leaving, entering)).alias("e")).select("e.*")
    # unlike edges on one side of a node: the least and the greatest differ
    sides = [side(F.when(F.col("out") == out, F.col("edge"))).alias(f"{name}_{out}") for out in (0, 1) for name, side in (("low", F.min), ("high", F.max))]
    degrees = ends.groupBy("node").agg(*sides, F.sum("out").alias("n")).where("low_0 < high_0 or low_1 < high_1")
    nodes = common.checkpoint(degrees.select(F.col("node").alias("tail"), "n"))
    return common.split_join(edges.select("key", "start", "tail"), nodes.select("tail"), ["tail"], nodes).select("key", "start").distinct()


def paths(docs: DataFrame, bodies: DataFrame, width: int = 13, hot: int = repeats.HOT) -> DataFrame:
    """key, start, words: verified passages whose every window also starts in an earlier document.

    Windows of ``width`` words are edges between nodes of one word less.  Runs of edges that share an
    anchor are met with equal runs whole, and edge by edge where runs of an anchor differ; what also
    stands in an earlier document is a repeated edge, with a source.  Paths compact by joins: a run
    goes on from the one before if that one ends where it begins, both here and at the source, and
    the node between them does not branch; else it heads a path.  Each path is one span with one
    source, and last the words at both coordinates are compared by a 128-bit digest of the words.
    """
    runs = common.arrow_map(docs, _runs, repeats.RUN, width, repeats.hot_anchors(docs, _counts, hot, width))
    found = common.checkpoint(repeats.shared(runs, True).drop("anchor", "hot"))
    single = common.arrow_map(repeats.at_places(bodies, found.where("not removed").select("key", "start", "count")), _edges, repeats.RUN, width)
    columns = ["key", "start", "count", "from_key", "from_start"]
    alone = repeats.shared(single, True).where("removed").select(columns)
    repeated = common.checkpoint(found.where("removed").select(columns).unionByName(alone).groupBy("key", "start", "count").agg(F.min(F.struct("from_key", "from_start")).alias("f")).select("key", "start", "count", "f.*"), release=True)
    cut = branching(repeated, bodies, width).withColumn("cut", F.lit(True))
    before = repeated.select("key", (F.col("start") + F.col("count")).alias("start"), "from_key", (F.col("from_start") + F.col("count")).alias("from_start"), F.lit(True).alias("goes_on")).distinct()
    linked = repeated.join(before, ["key", "start", "from_key", "from_start"], "left").join(cut, ["key", "start"], "left")
    linked = linked.withColumn("head", F.col("goes_on").isNull() | F.col("cut").isNotNull())
    order = Window.partitionBy("key", "from_key").orderBy("start", "from_start")
    path = linked.withColumn("path", F.sum(F.col("head").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    spans = path.groupBy("key", "from_key", "path").agg(F.min("start").alias("start"), F.min("from_start").alias("from_start"), (F.max(F.col("start") + F.col("count")) - F.min("start") + width - 1).cast("int").alias("words"), (F.max(F.col("from_start") + F.col("count")) - F.min("from_start") + width - 1).cast("int").alias("from_words"))
    spans = common.checkpoint(spans.drop("path"), release=True)
    sources = spans.select(F.col("from_key").alias("key"), F.col("from_start").alias("start"), F.col("from_words").alias("words"))
    places = spans.select("key", "start", "words").unionByName(sources).distinct()
    digests = common.arrow_map(repeats.at_places(bodies, places), _digests, "key long, start int, words int, digest binary")
    digests = digests.dropDuplicates(["key", "start", "words"])
    own = spans.join(digests, ["key", "start", "words"])
    source = digests.select(F.col("key").alias("from_key"), F.col("start").alias("from_start"), F.col("words").alias("from_words"), F.col("digest").alias("from_digest"))
    at = ["from_key", "from_start", "from_words"]
    counts = common.checkpoint(spans.groupBy(*at).agg(F.count("*").alias("n")))  # a passage of a third of all texts has one source
    return common.split_join(own, source, at, counts).where("digest = from_digest").select("key", "start", "words")


def dedup(docs: DataFrame, width: int = 13, digest: bool = False, carry: Sequence[str] = (), hot: int = repeats.HOT) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text (or with digest kept_sha256), and ``carry``, for each row.

    Removes each word that a window of ``width`` words covers whose words also start in a document
    with a smaller doc_id; windows are judged on the input.  Words are runs of bytes other than
    white space (0x20, 0x09 to 0x0D).  Where words go, those kept are joined by a space; the digest
    is always of words so joined.  Null, empty and short texts lose nothing (null: empty).  A null
    doc_id comes before all others.  Rows that share a doc_id are one document: what is repeated in
    one text is taken from each as far as it reaches.  An empty table gives no rows.  Columns that
    aren't carried are ignored; carried ones keep their names.
    """
    carried = {f"carried{i}": F.col(name) for i, name in enumerate(() if digest else carry)}
    bodies = common.packed(repeats.keyed(docs, carried))
    found = paths(repeats.keyed(docs), bodies.select("key", "body"), width, hot)
    common.drop_shuffles(docs.sparkSession)
    rows = repeats.at_places(bodies, found, "left")
    if digest:
        rows = common.arrow_map(rows, _digested, "key long, n_words long, n_removed long, kept_sha256 string")
    else:
        types = "".join(f", {name} {dict(docs.dtypes)[column]}" for name, column in zip(carried, carry, strict=True))
        rows = common.arrow_map(rows, _kept, f"key long, n_words long, n_removed long, kept_text string{types}")
    last = ["kept_sha256"] if digest else ["kept_text", *(F.col(name).alias(column) for name, column in zip(carried, carry, strict=True))]
    return rows.select(F.when(F.col("key") != repeats.NO_ID, F.col("key")).alias("doc_id"), "n_words", "n_removed", *last)
