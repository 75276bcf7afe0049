"""Op 2: document scores learnt from preference pairs (Bradley-Terry) and cut at a quantile."""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: The score that the cut-off quantile is given.
CUT_SCORE = 0.3
#: The share of rejected training rows below which the cut lies: clean rows are kept in doubt.
MARGIN = 0.97
#: Rows of a block, in which each row meets all of the other label, and rows of the rarer one there on average at
#: least; bins in which the place of the cut is looked for.
BLOCK, MET, BINS = 2048, 32, 1024

_LETTERS = str.maketrans("", "", "abcdefghijklmnopqrstuvwxyz")
_MARKS = "!?*#$%&|@=+_~^<>{}[]\\/"


def _shares(text: str) -> list[float]:
    """Shares between 0 and 1, of characters, words and lines."""
    n = len(text)
    if not n:
        return [0.0] * 26
    words = text.split()
    k = max(1, len(words))
    lower = text.lower()
    lines = [line for line in text.split("\n") if line]
    m = max(1, len(lines))
    marked = sum(text.count(mark) for mark in _MARKS)
    repeats = sum(map(eq, words, words[1:]))
    ends = text.count(".")
    distinct = len(set(words))
    upper_words = sum(map(str.isupper, words))
    by_line = []
    for line in lines:
        size = max(1, len(line))
        junk = sum(line.count(mark) for mark in "!*#$%&|@")
        by_line.append((junk * 8 > size or line.isupper(), size))
    total = sum(size for _, size in by_line) or 1
    return [
        min(1.0, n / 200),
        min(1.0, n / 2000),
        np.log1p(n) / 16,
        distinct / k,
        distinct / k**0.75 if k > 1 else 1.0,
        repeats / k,
        (repeats / k) ** 0.5,
        upper_words / k,
        (upper_words / k) ** 0.5,
        sum(map(str.istitle, words)) / k,
        marked / n,
        (marked / n) ** 0.5,
        min(1.0, text.count("!") / k),
        min(1.0, sum(map(text.count, "*#$%&")) / k),
        min(1.0, text.count("|") / k),
        min(1.0, text.count("|") / k) ** 0.5,
        min(1.0, ends / k),
        min(1.0, ends * 12 / k),
        text.count(",") / k if k else 0.0,
        sum(map(text.count, "0123456789")) / n,
        min(1.0, (n - len(words)) / k / 20),
        len(set(lines)) / m,
        min(1.0, k / m / 100),
        sum(size for junk, size in by_line if junk) / total,
        float(any(junk for junk, _ in by_line)),
        len(lower.translate(_LETTERS)) / max(1, len(lower)),
    ]


def features(text: str) -> list[float]:
    """What a score is made of; only the text counts."""
    return _shares(text)


N_FEATURES = len(features("a"))


def _matrix(texts: pa.Array) -> np.ndarray:
    """Features in the precision that they are kept in, so that training and scoring see the same."""
    return np.array([features(text or "") for text in texts.to_pylist()], np.float32).reshape(-1, N_FEATURES).astype(np.float64)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = pa.FixedSizeListArray.from_arrays(pa.array(_matrix(batch["text"]).astype(np.float32).ravel()), N_FEATURES).cast(pa.list_(pa.float32()))
        yield pa.RecordBatch.from_arrays([batch["doc_id"], lists], ["doc_id", "features"])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 5 == 0, F.lit(True))


class Model:
    """score(x) = sigmoid(weights . standardised features - cut + logit(CUT_SCORE))."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, weights: np.ndarray, cut: float):
        self.mean, self.spread, self.weights, self.cut = mean, spread, weights, cut

    def raw(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.spread) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip(self.raw(x) - self.cut + np.log(CUT_SCORE / (1 - CUT_SCORE)), -30, 30)
        return 1 / (1 + np.exp(-z))


def _numbers(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, N_FEATURES).astype(np.float64)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a task's rows: weights and numbers of both labels, mean and sum of squares about it."""
    counts, mean, squares = np.zeros(4), np.zeros(N_FEATURES), np.zeros(N_FEATURES)
    for batch in batches:
        if batch.num_rows:
            x, n, bad = _numbers(batch["features"]), np.asarray(batch["n"], np.float64), np.asarray(batch["quality"]) == 0
            one = n @ x / n.sum()
            counts, mean, squares = _added((counts, mean, squares), (np.array([n[bad].sum(), n[~bad].sum(), bad.sum(), (~bad).sum()]), one, n @ (x - one) ** 2))
    yield pa.RecordBatch.from_arrays([pa.array([list(values)]) for values in (counts, mean, squares)], ["counts", "mean", "squares"])


def _added(one: tuple, other: tuple) -> tuple:
    """Moments of two sets of rows together."""
    n, m = one[0][:2].sum(), other[0][:2].sum()
    if not n or not m:
        return other if m else one
    apart = other[1] - one[1]
    return one[0] + other[0], one[1] + apart * m / (n + m), one[2] + other[2] + apart**2 * n * m / (n + m)


def _block(group: pa.Table) -> pa.Table:
    """A block's rows as one row: features and weights of each label, in an order of their own."""
    x, n, label = _numbers(group["features"].combine_chunks()), np.asarray(group["n"], np.float64), np.asarray(group["quality"])
    order = np.lexsort(x.T)
    x, n, label = x[order].astype(np.float32), n[order], label[order]
    out = [part.tobytes() for y in (1, 0) for part in (x[label == y], n[label == y])]
    return pa.Table.from_arrays([pa.array([part], pa.binary()) for part in out], ["good", "good_n", "bad", "bad_n"])


def _slopes(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """Sums over all pairs of a task's blocks: weight, gradient and curvature of the logistic loss."""
    total, gradient, curve = 0.0, np.zeros(N_FEATURES), np.zeros((N_FEATURES, N_FEATURES))
    for batch in batches:
        for row in batch.to_pylist():
            a, b = ((np.frombuffer(row[k], np.float32).reshape(-1, N_FEATURES) - model.mean) / model.spread for k in ("good", "bad"))
            n, m = np.frombuffer(row["good_n"]), np.frombuffer(row["bad_n"])
            p = 1 / (1 + np.exp(np.clip((a @ model.weights)[:, None] - b @ model.weights, -30, 30)))
            first = p * n[:, None] * m
            second = first * (1 - p)
            across = a.T @ second @ b
            total += n.sum() * m.sum()
            gradient -= first.sum(1) @ a - first.sum(0) @ b
            curve += a.T @ (second.sum(1)[:, None] * a) + b.T @ (second.sum(0)[:, None] * b) - across - across.T
    yield pa.RecordBatch.from_arrays([pa.array([total]), pa.array([list(gradient)]), pa.array([list(curve.ravel())])], ["total", "gradient", "curve"])


def _raws(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(model.raw(_numbers(batch["features"]))), batch["n"]], ["raw", "n"])


def _blocks(rows: DataFrame, counts: np.ndarray) -> DataFrame:
    """Rows dealt over blocks by their hash; where rows of the rarer label are few, each goes to several blocks."""
    number = int(-(-counts[2:].sum() // BLOCK))
    rarer, few = int(np.argmin(counts[2:])), counts[2:].min()
    copies = int(min(number, max(1, -(-MET * number // few))))
    each = F.sequence(F.lit(0), F.when(F.col("quality") == rarer, copies - 1).otherwise(0))
    dealt = rows.withColumn("_copy", F.explode(each)).withColumn("block", F.pmod(F.xxhash64("features") + F.col("_copy") * (number // copies), F.lit(number)))
    return common.checkpoint(common.arrow_groups(dealt.select("block", "quality", "n", "features"), ["block"], _block, "good binary, good_n binary, bad binary, bad_n binary"))


def _quantile(raws: DataFrame, share: float) -> float:
    """The exact quantile of column raw with weights n, between its two neighbours in proportion.

    Each pass counts the bins of a range, then goes on in the bin that holds the place.
    """
    ends = raws.agg(F.min("raw"), F.max("raw"), F.sum("n")).first()
    low, high, place, below = ends[0], ends[1], (ends[2] - 1) * share, 0
    k = int(place)
    after = min(k + 1, ends[2] - 1)
    while low < high:
        bins = F.least(F.lit(BINS - 1), F.floor((F.col("raw") - low) / ((high - low) / BINS))).alias("bin")
        counted = raws.where(F.col("raw").between(low, high)).groupBy(bins).agg(F.sum("n").alias("n"), F.min("raw").alias("low"), F.max("raw").alias("high")).orderBy("bin").collect()  # BINS rows at most
        reached = below + np.cumsum([r["n"] for r in counted])
        i, j = (int(np.searchsorted(reached, at, "right")) for at in (k, after))
        if i != j:
            return counted[i]["high"] + (counted[j]["low"] - counted[i]["high"]) * (place - k)
        low, high, below = counted[i]["low"], counted[i]["high"], int(reached[i]) - counted[i]["n"]
    return low


def fit(rows: DataFrame) -> Model:
    """Bradley-Terry: P(a preferred to b) = sigmoid(w . (a - b)), over pairs with unlike labels.

    rows has quality, features and n, how often they stand.  Each row meets all rows of the other label
    in its block, so all teach, and pairs grow with the rows.  Minimises the mean logistic loss of the
    feature differences with a small ridge, by Newton's method; a step's sums come from one pass
    over the blocks, and only they go to the driver.  The cut is the quantile of all rows' scores at
    MARGIN times the share of label 0.  With one label only there are no pairs: weights are 0, and
    all scores lie at the cut.
    """
    moments = (np.zeros(4), np.zeros(N_FEATURES), np.zeros(N_FEATURES))
    for r in common.arrow_map(rows, _moments, "counts array<double>, mean array<double>, squares array<double>").collect():  # one row a task
        moments = _added(moments, tuple(np.array(r[c]) for c in ("counts", "mean", "squares")))
    counts, mean, squares = moments
    model = Model(mean, np.ones(N_FEATURES), np.zeros(N_FEATURES), 0.0)
    if not counts[:2].sum():
        return model
    model.spread = np.sqrt(squares / counts[:2].sum()) + 1e-6
    if not counts[:2].all():
        return model
    blocks, ridge = _blocks(rows, counts), 1e-3
    for _ in range(25):
        sums = common.arrow_map(blocks, _slopes, "total double, gradient array<double>, curve array<double>", model).collect()  # one row a task
        total = sum(r["total"] for r in sums)
        gradient = sum(np.array(r["gradient"]) for r in sums) / total + ridge * model.weights
        curve = sum(np.array(r["curve"]) for r in sums).reshape(N_FEATURES, -1) / total + ridge * np.eye(N_FEATURES)
        step = np.linalg.solve(curve, gradient)
        model.weights = model.weights - step
        if np.abs(step).max() < 1e-6:
            break
    raws = common.checkpoint(common.arrow_map(rows, _raws, "raw double, n long", model))
    model.cut = _quantile(raws, MARGIN * counts[0] / counts[:2].sum())
    return model


def described(docs: DataFrame) -> DataFrame:
    """doc_id and features of each row."""
    return common.arrow_map(common.with_text(docs), _features, "doc_id long, features array<float>")


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fits on all labelled rows that aren't held out."""
    return _taught(described(docs), labels)


def _taught(extracted: DataFrame, labels: DataFrame) -> Model:
    """Texts aren't moved: features of all rows meet the labels, and equal ones count together."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where("quality in (0, 1)").where(~held_out(F.col("doc_id"))).distinct()
    rows = extracted.join(known, "doc_id").groupBy("quality", "features").agg(F.count("*").alias("n"))
    return fit(common.checkpoint(rows))


def _scores(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(model.score(_numbers(batch["features"])))], ["doc_id", "score"])


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for each row; higher means that label 1 is likelier.

    Null or empty text: scored from zero features.  Null doc_id: held out.  Labels other than 0 and
    1, and labels of unknown documents, teach nothing; several labels of one document all do, but
    equal ones once.  Repeated rows get equal scores.  No labels: every score is 0.3.  Empty table:
    no rows.  Other columns of either table are ignored.  Features are computed once and kept.
    """
    extracted = common.checkpoint(described(docs))
    scored = common.arrow_map(extracted, _scores, "doc_id long, score double", _taught(extracted, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= CUT_SCORE).cast("int").alias("predicted"))


def _keep(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.filter(pa.array(model.score(_matrix(batch["text"])) >= CUT_SCORE))


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows, with all their columns, whose score reaches the cut; cases as in score."""
    return common.arrow_map(docs, _keep, docs.schema, train(docs, labels))
