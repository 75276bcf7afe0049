"""Op 8: sum-of-squares online packing of token sequences into windows."""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame

from . import common

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, placed string"
#: Sequences that one task may number.
TASK_BITS = 36
#: Tokens of one fill level; a document may be cut by fewer to fill a window.
GRAIN = 64


class Levels:
    """Open windows by fill level, for the online rule that keeps all levels about equally used.

    Level l holds the windows filled by more than (l - 1) * grain and at most l * grain tokens;
    count[l] is how many are open.  An item goes into the level (0: a new window) for which the sum
    of squared counts grows least; full windows don't count.  Ties go to the fullest window.  Of a
    level only its last window is tried.  An item that is too long by fewer than ``grain`` tokens
    still fits, as what is over can be cut off; with a grain of 1 nothing is ever cut.
    """

    def __init__(self, width: int, grain: int = 1):
        self.width, self.grain = width, grain
        levels = -(-width // grain) + 1
        self.count = np.zeros(levels, np.int64)
        self.fill = np.zeros(levels, np.int64)  # of each level's last window
        self.open: list[list[tuple[int, list]]] = [[] for _ in range(levels)]

    def level(self, size: int) -> int:
        """The level that an item of this length goes into."""
        count = self.count
        after = self.fill + size
        to = -(-np.minimum(after, self.width) // self.grain)
        growth = np.where(to == np.arange(len(to)), 0, 2 * (count[to] - count) + 2)  # (n + 1)^2 - n^2 there, (n - 1)^2 - n^2 here
        growth = np.where(after >= self.width, 1 - 2 * count, growth)  # full windows leave the array
        growth[0] = 1 if size >= self.width else 2 * count[to[0]] + 1  # a new window takes none away
        bad = after >= self.width + self.grain
        bad[1:] |= count[1:] == 0
        growth[bad] = np.iinfo(np.int64).max
        return len(growth) - 1 - int(np.argmin(growth[::-1]))

    def room(self, level: int) -> int:
        """Tokens that the window which level names can still take."""
        return self.width - int(self.fill[level])

    def place(self, size: int, piece, level: int | None = None) -> list | None:
        """Puts a piece in, no longer than there is room; returns the window's pieces if it is full."""
        at = self.level(size) if level is None else level
        fill, window = self.open[at].pop() if at else (0, [])
        if at:
            self._counted(at)
        window.append(piece)
        fill += size
        if fill == self.width:
            return window
        to = -(-fill // self.grain)
        self.open[to].append((fill, window))
        self._counted(to)
        return None

    def _counted(self, level: int) -> None:
        self.count[level] = len(self.open[level])
        self.fill[level] = self.open[level][-1][0] if self.open[level] else 0

    def rest(self) -> list[tuple[int, list]]:
        """Fill and pieces of the windows still open, fullest first."""
        return sorted((window for windows in self.open for window in windows), key=lambda window: -window[0])


def pack(documents: Iterator[tuple[int, np.ndarray]], width: int, grain: int = GRAIN) -> Iterator[list[tuple[int, np.ndarray, int, int, str]]]:
    """Windows of (doc_id, ids, start, end, how placed) in order; each is full or of a power of two.

    Whole windows are cut off a document's front; its rest is placed online.  At the end the fullest
    open windows stay as they are and are filled up with the pieces of the least full ones, as many
    as it takes; the remainder, less than a window, is cut to powers of two.
    """
    levels = Levels(width, min(grain, width))
    for doc_id, ids in documents:
        start, size = 0, len(ids)
        while size - start >= width:
            yield [(doc_id, ids, start, start + width, "whole")]
            start += width
        while start < size:
            level = levels.level(size - start)
            end = min(size, start + levels.room(level))
            full = levels.place(end - start, (doc_id, ids, start, end, "online"), level)
            if full:
                yield full
            start = end
    left = levels.rest()
    total = sum(fill for fill, _ in left)
    stay = total // width
    pieces = iter([piece for _, window in left[stay:] for piece in window])
    piece = next(pieces, None)
    windows = [(window, width - fill) for fill, window in left[:stay]]
    windows += [([], 1 << bit) for bit in range(width.bit_length() - 1, -1, -1) if (total % width) >> bit & 1]
    for window, gap in windows:
        while gap:
            doc_id, ids, start, end, _ = piece
            take = min(gap, end - start)
            window.append((doc_id, ids, start, start + take, "moved"))
            gap -= take
            piece = (doc_id, ids, start + take, end, "moved") if start + take < end else next(pieces, None)
        yield window


@lru_cache(maxsize=2)
def encoding(path: str, pattern: str, added: bool = False) -> tiktoken.Encoding:
    """The byte-level vocabulary of a tokenizers file; its ids are in the order of its merges.

    tiktoken gives the ids that the tokenizers library gives, several times faster; with added also
    those of the file's added tokens, as the library does unless encode_special_tokens is set.
    """
    with open(path, encoding="utf-8") as file:
        whole = json.load(file)
    model, special = whole["model"], {}
    for token in whole["added_tokens"] if added else ():
        if token["single_word"] or token["lstrip"] or token["rstrip"] or token["normalized"] or any(token["content"].startswith(x) or x.startswith(token["content"]) for x in special):
            raise ValueError(f"added token {token['content']!r} isn't matched as plain text")
        special[token["content"]] = token["id"]
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in set(printable)]
    byte = {chr(x): x for x in printable} | {chr(256 + i): x for i, x in enumerate(others)}
    ranks = {bytes(byte[c] for c in token): rank for token, rank in model["vocab"].items() if all(c in byte for c in token)}
    merged = {a + b for a, b in (m.split(" ") if isinstance(m, str) else m for m in model["merges"])}
    ranks = {token: rank for token, rank in ranks.items() if len(token) == 1} | {bytes(byte[c] for c in token): model["vocab"][token] for token in merged}
    return tiktoken.Encoding("packed", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)


def _documents(batches: Iterator[pa.RecordBatch], path: str, pattern: str, end_id: int, added: bool) -> Iterator[tuple[int, np.ndarray]]:
    encode, end = encoding(path, pattern, added).encode_to_numpy, np.array([end_id], "<u4")
    for batch in batches:
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
            yield doc_id, np.concatenate([encode(text, allowed_special="all", disallowed_special=()).astype("<u4", copy=False), end])


def _rows(batches: Iterator[pa.RecordBatch], path: str, pattern: str, end_id: int, width: int, keep_ids: bool, added: bool) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(name, pa.int64()) for name in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")] + [("placed", pa.string())] + [("ids", pa.binary())] * keep_ids)
    sequence, rows = TaskContext.get().partitionId() << TASK_BITS, []
    for window in pack(_documents(batches, path, pattern, end_id, added), width):
        offset = 0
        for doc_id, ids, start, end, placed in window:
            cut = ids[start:end].tobytes()
            rows.append((doc_id, start, end - start, zlib.crc32(cut), len(ids), sequence, offset, placed, *[cut] * keep_ids))
            offset += end - start
        sequence += 1
        if len(rows) >= 4096:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
            rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def pack_documents(docs: DataFrame, path: str, pattern: str, end_id: int = 1, width: int = 2048, keep_ids: bool = True, added: bool = False) -> DataFrame:
    """One row per piece of a document, with its place; with keep_ids also its ids (packed u32).
    Added tokens of the file are plain text, or with added have their own ids.

    Each task packs its own rows and leaves no window that is neither full nor of a power of two,
    so tasks needn't meet and no padding is left; sequence_id holds the task and a running number.
    placed tells how a piece came to its place: whole (a whole window off a long document), online
    (by the sum of squares) or moved (at the task's end, to fill up windows that stayed open).
    width must be a power of two for that.  Null or empty text: the end id alone.  Long texts: cut
    into whole windows and a rest.  Repeated rows are packed each; an empty table gives no rows;
    other columns are ignored.  A null doc_id stays null.
    """
    return common.arrow_map(common.with_text(docs), _rows, PIECE + ", ids binary" * keep_ids, path, pattern, end_id, width, keep_ids, added)
