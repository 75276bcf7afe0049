"""Op 12: periodic runs of words by Lyndon roots, and texts with each run cut to its first period."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: What sets words apart, as a pattern of Spark's; bytes.split does the same.
WORD_GAP = "[\\x20\\x09-\\x0D]+"
#: Fingerprints are polynomials modulo two primes, each product of which fits into 64 bits.
MODULI = ((2147483647, 1103515245), (2147483629, 214013))
#: Words of the chunks in which documents are searched together; a longer one is a chunk of its own.
CHUNK = 1 << 15
#: Words that are compared one after another before fingerprints are.
NEAR = 32
FOUND = "runs array<struct<start: long, length: long, period: long>>"


class Words:
    """A sequence of word numbers, at least 1, with fingerprints of all its substrings."""

    def __init__(self, numbers: np.ndarray):
        self.n, self.numbers, self.list = len(numbers), numbers, [*numbers.tolist(), 0]
        self.prefixes, self.powers = [], []
        for prime, base in MODULI:
            power = np.ones(self.n + 1, np.uint64)
            have = 1
            while have <= self.n:
                more = min(have, self.n + 1 - have)
                power[have : have + more] = power[:more] * np.uint64(pow(base, have, prime)) % np.uint64(prime)
                have += more
            terms = (numbers.astype(np.uint64) * np.uint64(2654435761) + np.uint64(97)) % np.uint64(prime) * power[: self.n] % np.uint64(prime)
            self.powers.append(power)
            self.prefixes.append(np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64) % np.uint64(prime))))
        self.seen: dict[int, tuple[int, int]] = {}
        self._scalars: list[tuple[int, list[int], list[int]]] = []

    def alike(self, i: np.ndarray, j: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether fingerprints of the substrings at i and j > i agree."""
        out = np.ones(len(i), bool)
        for (prime, _), prefix, power in zip(MODULI, self.prefixes, self.powers, strict=True):
            p = np.uint64(prime)
            a, b = (prefix[i + length] + p - prefix[i]) % p, (prefix[j + length] + p - prefix[j]) % p
            out &= a * power[j - i] % p == b
        return out

    def extend(self, i: np.ndarray, j: np.ndarray, back: bool = False) -> np.ndarray:
        """How many words agree from i and j > i on (back: before them), by binary search over fingerprints."""
        room = i.copy() if back else self.n - j
        low, high = np.zeros(len(i), np.int64), room
        while (open_ := low < high).any():
            half = np.where(open_, (low + high + 1) // 2, low)
            same = self.alike(i - half, j - half, half) if back else self.alike(i, j, half)
            low, high = np.where(open_ & same, half, low), np.where(open_ & ~same, half - 1, high)
        return low

    def compare(self, i: np.ndarray, j: np.ndarray, back: bool = False) -> np.ndarray:
        """As extend, word by word."""
        out = np.zeros(len(i), np.int64)
        for k, (a, b) in enumerate(zip(i.tolist(), j.tolist(), strict=True)):
            while (a > out[k] if back else b + out[k] < self.n) and self.list[a - out[k] - 1 if back else a + out[k]] == self.list[b - out[k] - 1 if back else b + out[k]]:
                out[k] += 1
        return out

    def common(self, i: int, j: int) -> int:
        """As extend, for one pair, with its words compared; where words at this distance agreed last is remembered."""
        words, shift, high = self.list, j - i, self.n - j
        a, b = self.seen.get(shift, (0, 0))
        if a <= i < b:
            return b - i
        if i < a <= i + NEAR and words[i:a] == words[j : a + shift]:
            self.seen[shift] = (i, b)
            return b - i
        for low in range(0, NEAR, 8):
            if words[i + low : i + low + 8] != words[j + low : j + low + 8]:  # the text ends with a word 0, that nothing equals
                return next(k for k in range(low, low + 8) if words[i + k] != words[j + k])
        low, step = NEAR, NEAR
        scalars = self.scalars()
        while low < high:  # gallop, then halve
            half = min(high, low + step) if step else (low + high + 1) // 2
            for prime, prefix, power in scalars:
                if ((prefix[i + half] - prefix[i]) * power[shift] - prefix[j + half] + prefix[j]) % prime:
                    high, step = half - 1, 0
                    break
            else:
                low, step = half, step * 2
        end = i + low
        if words[i:end] != words[j : end + shift]:  # fingerprints agreed by chance
            end = next(x for x in range(i, end) if words[x] != words[x + shift])
        self.seen[shift] = (i, end)
        return end - i

    def scalars(self) -> list[tuple[int, list[int], list[int]]]:
        if not self._scalars:
            self._scalars = [(prime, prefix.tolist(), power.tolist()) for (prime, _), prefix, power in zip(MODULI, self.prefixes, self.powers, strict=True)]
        return self._scalars


def roots(words: Words, reverse: bool) -> np.ndarray:
    """Where the longest Lyndon word that starts at each place ends, in one order of words or its reverse.

    The end is where the next smaller suffix starts.  Scanned from right to left, the places that
    follow one another as such form the stack; the end of the text is smaller than any word in both orders.
    """
    n = words.n
    top = int(words.numbers.max(initial=0)) + 1
    numbers = top - words.numbers if reverse else words.numbers
    keys = numbers.copy()  # as many words as a number holds
    for k in range(1, max(1, 62 // top.bit_length())):
        keys = (keys << top.bit_length()) + np.append(numbers[k:], np.zeros(min(k, n), np.int64))
    single, keys = [*numbers.tolist(), 0], keys.tolist()
    ends = [n] * (n + 1)
    common = words.common
    for i in range(n - 2, -1, -1):
        mine, j = keys[i], i + 1
        while j < n:
            other = keys[j]
            if mine < other:
                j = ends[j]
            elif mine > other:
                break
            else:
                k = common(i, j)
                if j + k < n and single[i + k] < single[j + k]:
                    j = ends[j]
                else:
                    break
        ends[i] = j
    return np.array(ends[:n], np.int64)


def find_runs(numbers: np.ndarray, least: int) -> np.ndarray:
    """start, length, period of each run of at least so many words, by start and period.

    A run's root is, in one of the two orders, the longest Lyndon word at its place; so each place's
    two Lyndon words are extended to both sides, and what is two periods long at least is a run.
    Each run's words are compared; should fingerprints have agreed by chance, all words are.
    """
    words = Words(numbers)
    i = np.tile(np.arange(words.n, dtype=np.int64), 2)
    j = np.concatenate([roots(words, False), roots(words, True)])
    inside = j < words.n
    i, j = i[inside], j[inside]
    near = (numbers[i] == numbers[j]) | ((i > 0) & (numbers[i - 1] == numbers[j - 1]))
    i, j = i[near], j[near]
    for extend in (words.extend, words.compare):
        right, left = extend(i, j), extend(i, j, back=True)
        period = j - i
        long = left + right >= np.maximum(period, least - period)
        runs = np.unique(np.stack((i - left, period + left + right, period), 1)[long], axis=0)
        if all((numbers[s : s + n - q] == numbers[s + q : s + n]).all() for s, n, q in runs.tolist()):
            break
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _search(texts: list[list[bytes]], least: int) -> list[np.ndarray]:
    """The runs of each text, several texts at once: each is followed by a word that stands nowhere else."""
    number = defaultdict(count(1).__next__)
    flat = list(map(number.__getitem__, chain.from_iterable(texts)))
    bounds = np.concatenate(([0], np.cumsum([len(text) for text in texts])))
    marked = np.insert(np.array(flat, np.int64), bounds[1:-1], len(number) + 1 + np.arange(len(texts) - 1))
    runs = find_runs(marked, least)
    starts = bounds[:-1] + np.arange(len(texts))
    of = np.searchsorted(starts, runs[:, 0], "right") - 1
    cut = np.searchsorted(of, np.arange(len(texts) + 1))
    return [runs[cut[k] : cut[k + 1]] - [starts[k], 0, 0] for k in range(len(texts))]


def collapse(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words that no run holds after its first period, joined by single spaces."""
    if not len(runs):
        return b" ".join(words)
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([w for w, gone in zip(words, np.cumsum(edges).tolist(), strict=False) if not gone])


def _detect(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    names = ("start", "length", "period")
    for batch in batches:
        texts = [text.split() for text in batch["text"].cast(pa.binary()).to_pylist()]
        found: list[np.ndarray] = []
        at = 0
        while at < len(texts):
            end, size = at + 1, len(texts[at])
            while end < len(texts) and size + len(texts[end]) < CHUNK:
                size += len(texts[end])
                end += 1
            found += _search(texts[at:end], least)
            at = end
        columns = [pa.array([len(t) for t in texts], pa.int64()), pa.array([[dict(zip(names, r, strict=True)) for r in runs.tolist()] for runs in found], kind), pa.array([collapse(t, r) for t, r in zip(texts, found, strict=True)], pa.binary()).cast(pa.string())]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], *columns], ["doc_id", "n_words", "runs", "collapsed"])


def detect(docs: DataFrame, least: int = 12) -> DataFrame:
    """doc_id, n_words, runs (start, length, period) and collapsed text of each document.

    Words are what single or repeated spaces and control characters from tab to carriage return set
    apart, numbered from 0.  A run is a stretch whose words repeat with a smallest period of at most half its
    length, which no neighbouring word extends and which has `least` words or more.  The collapsed
    text lacks the words that a run holds after its first period.

    Null, empty and wordless texts: no words, no runs, an empty collapsed text.  Repeated rows and
    rows that share a doc_id, or have none, each give a row.  Empty table: no rows.  Other columns
    are ignored.  A text is searched whole in one task, in n log n steps; nothing is shuffled.
    """
    return common.arrow_map(common.with_text(docs), _detect, f"doc_id long, n_words long, {FOUND}, collapsed string", least)


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text, where one in ten documents goes round in a period from some word on.

    h is the CRC-32 of the decimal doc_id; with h % 10 = 0, g = h div 10 gives the first such word,
    g % n, and the period, 1 + (n - a) div (3 + g % 8).  A null doc_id has no h, so its text stays.
    """
    rows = common.with_text(docs)
    h = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8"))
    words = F.when(h % 10 == 0, F.filter(F.split("text", WORD_GAP), lambda w: w != ""))
    rows = rows.select("doc_id", "text", words.alias("w"), F.floor(h / 10).alias("g"))
    n = F.size("w")
    rows = rows.select("*", F.when(n > 0, (F.col("g") % n).cast("int")).alias("a"))
    period = (F.floor((n - F.col("a")) / (3 + F.col("g") % 8)) + 1).cast("int")
    rows = rows.select("doc_id", "text", "w", "a", period.alias("p"))
    head = F.slice("w", F.lit(1), F.col("a"))
    tail = F.transform(F.sequence(F.lit(0), n - F.col("a") - 1), lambda i: F.get("w", F.col("a") + i % F.col("p")))
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(F.concat(head, tail), " ")).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """Counts, the longest run and digests of detect's rows, one row each."""
    best: Column = F.element_at(F.array_sort(F.transform("runs", lambda r: F.struct((-r["length"]).alias("least"), r["start"].alias("start"), r["period"].alias("period")))), 1)
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.when(F.size("runs") > 0, best).alias("b"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    length = -F.col("b.least")
    return rows.select("doc_id", "n_runs", F.col("b.start").alias("start"), length.alias("length"), F.col("b.period").alias("period"), F.floor(length * 1000 / F.col("b.period")).alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
