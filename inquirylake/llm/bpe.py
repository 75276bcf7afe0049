"""Op 1: byte-level BPE in linear time, by longest matches and backtracking."""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from . import chunks, common

#: Matches whose ids a worker remembers.
REMEMBERED = 200_000


class Encoder:
    """Merges exactly as rank order would, without running the merges.

    A sequence of tokens is what merging gives just when each adjacent pair is compatible: merging
    the two tokens' bytes alone gives back these two.  So the encoder takes the longest token at
    each place, falls back to shorter ones, and steps back when none fits; places found to be dead
    ends are marked, so each is left at most once for each token.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes = {rank: token for token, rank in ranks.items()}
        self.latin = {token.decode("latin-1"): rank for token, rank in ranks.items()}
        self.size = {rank: len(token) for token, rank in ranks.items()}
        self.reach = max(map(len, ranks), default=0)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for token in self.latin:
            self.automaton.add_word(token)
        self.automaton.make_automaton()
        self.stretch = self.automaton.longest_prefix
        #: what begins some token -> the longest token that it begins with
        self.within: dict[str, int] = {}
        for token in self.latin:
            for length in range(1, len(token) + 1):
                start = token[:length]
                if start not in self.within:
                    rank = self.latin.get(start)
                    self.within[start] = self.within.get(start[:-1]) if rank is None else rank
        self.shorter: dict[int, int] = {}
        self.joined: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.compatible: dict[tuple[int, int], bool] = {}
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            self.halves[rank] = (rank, rank)
            for cut in range(len(token) - 1, 0, -1):
                left = ranks.get(token[:cut])
                if left is None:
                    continue
                self.shorter.setdefault(rank, left)
                right = ranks.get(token[cut:])
                if right is not None and left < rank and right < rank and self.fits(left, right):
                    self.joined[left, right] = rank
                    self.halves[rank] = (left, right)
                    break
        # pairs judged while the table grew may look compatible only because a merge was missing
        self.compatible.clear()

    def fits(self, left: int, right: int) -> bool:
        """Whether the boundary between two adjacent tokens survives merging."""
        known = self.compatible.get((left, right))
        if known is not None:
            return known
        a, b, bound, fit = left, right, 1 << 62, None
        while fit is None:
            merged = self.joined.get((a, b))
            if merged is not None and merged < bound:
                fit = False
            elif a > b:
                # the younger token is the left one: undo its last merge
                inner = self.halves[a][1]
                if inner != a:
                    bound, a = a, inner
                else:
                    inner = self.halves[b][0]
                    if inner == b:
                        fit = True
                    bound, b = b + 1, inner
            else:
                inner = self.halves[b][0]
                if inner != b:
                    bound, b = b + 1, inner
                else:
                    inner = self.halves[a][1]
                    if inner == a:
                        fit = True
                    bound, a = a, inner
        if len(self.compatible) >= 2_000_000:
            self.compatible.clear()
        self.compatible[left, right] = fit
        return fit

    def longest(self, text: str, at: int) -> int:
        """The longest token that starts there, from the longest stretch that begins some token."""
        window = text[at : at + self.reach]
        return self.within[window[: self.stretch(window)]]

    def encode(self, piece: bytes) -> list[int]:
        text = piece.decode("latin-1")
        whole = self.latin.get(text)
        if whole is not None:
            return [whole]
        end, size, longest, shorter, compatible = len(text), self.size, self.longest, self.shorter, self.compatible
        dead: set[int] = set()
        tokens: list[int] = []
        at, before, token = 0, None, longest(text, 0)
        while True:
            while token is not None:
                to = at + size[token]
                if to not in dead:
                    if before is None:
                        break
                    fit = compatible.get((before, token))
                    if self.fits(before, token) if fit is None else fit:
                        break
                token = shorter.get(token)
            if token is not None:
                tokens.append(token)
                if to == end:
                    return tokens
                at, before, token = to, token, longest(text, to)
            else:
                dead.add(at)
                last = tokens.pop()
                at -= size[last]
                before, token = tokens[-1] if tokens else None, shorter.get(last)


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    with open(path, "rb") as lines:
        return Encoder({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)})


class Matches(dict):
    """Match of the pattern -> its ids, packed."""

    def __init__(self, owner: Encoder):
        super().__init__()
        self.owner = owner

    def ids(self, match: str) -> bytes:
        return array("I", self.owner.encode(match.encode())).tobytes()

    def __missing__(self, match: str) -> bytes:
        ids = self.ids(match)
        if len(match) <= chunks.LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[match] = ids
        return ids


@lru_cache(maxsize=4)
def parts(path: str, pattern: str) -> chunks.Parts:
    """The parts of texts; a part of letters alone is one match of the pattern."""
    find, matches = regex.compile(pattern).findall, Matches(encoder(path))

    def ids(text: str) -> bytes:
        if text[1:].isalpha() and text[0] == " ":
            return matches.ids(text)
        return b"".join([words[m[1:]] if m[0] == " " and m[1:].isalpha() else matches[m] for m in find(text)])

    words = chunks.Parts(ids)
    return words


def encode_text(text: str, path: str, pattern: str) -> bytes:
    return chunks.encode(text, parts(path, pattern))


def decode_ids(ids: bytes, path: str) -> bytes:
    return b"".join(map(encoder(path).bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _rows(batches: Iterator[pa.RecordBatch], path: str, pattern: str, digest: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = [encode_text(text, path, pattern) for text in batch["text"].to_pylist()]
        decoded = [decode_ids(x, path) for x in ids]
        counts = pa.array([len(x) // 4 for x in ids], pa.int64())
        if digest:
            kept = [pa.array([hashlib.sha256(x).hexdigest() for x in values]) for values in (ids, decoded)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], counts, *kept], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        else:
            lists = pa.array([np.frombuffer(x, "<u4").astype("i4") for x in ids], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], counts, lists, pa.array(decoded, pa.binary())], ["doc_id", "n_tokens", "ids", "decoded"])


def tokenize(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids array<int>, decoded binary for each row; no row is dropped.

    Null or empty text: no ids.  Special tokens' strings are ordinary text.  Very long texts and
    matches take time in proportion to their length.  Repeated rows give equal rows.  The row's
    other columns are ignored.  Every byte must have a token in the rank file at path.
    """
    return common.arrow_map(common.with_text(docs), _rows, "doc_id long, n_tokens long, ids array<int>, decoded binary", path, pattern, False)


def token_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """As tokenize, with the SHA-256 of the packed ids and of the decoded bytes in place of both."""
    return common.arrow_map(common.with_text(docs), _rows, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", path, pattern, True)
